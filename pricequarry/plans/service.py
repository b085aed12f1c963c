"""The edge of the library: calls by name with plain results, remembered per arguments."""

from __future__ import annotations

import datetime
import math
import subprocess
import threading
from collections import OrderedDict
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricequarry.plans import analytics as A
from pricequarry.plans.filters import Filters, core_subset

CALLS: Mapping[str, Callable[..., DataFrame]] = {
    "code_summary": A.code_summary, "histogram": A.histogram, "benchmark_markers": A.benchmark_markers, "benchmarks": A.benchmarks, "summarize": A.summarize, "summary_page": A.summary_page,
    "map_points": A.map_points, "unmapped_providers": A.unmapped_providers, "point_providers": A.point_providers, "rate_type_composition": A.rate_type_composition, "profile": A.profile,
    "uniform_or_split": A.uniform_or_split, "type_mix": A.type_mix, "entity_list": A.entity_list,
}
# what a call leaves out of the filters, so that it is known whether the core subset may stand in for the fact
LEFT_OUT = {"code_summary": {"dollar_rates_only"}, "rate_type_composition": {"dollar_rates_only"}}


def plain(v: object) -> object:
    """Dates as ISO text, NaN and infinities as None, rows and lists as dicts and lists."""
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    if isinstance(v, float) and not math.isfinite(v):
        return None
    if hasattr(v, "asDict"):
        return {k: plain(x) for k, x in v.asDict().items()}
    if isinstance(v, dict):
        return {k: plain(x) for k, x in v.items()}
    return [plain(x) for x in v] if isinstance(v, (list, tuple)) else v


class Service:
    """Answers calls over a fact table; thread safe. The ``most`` last answers are kept, at most ``most_rows`` rows each."""

    def __init__(self, fact: DataFrame, most: int = 512, most_rows: int = 100_000) -> None:
        self.fact, self.core = fact, core_subset(fact)
        self.most, self.most_rows = most, most_rows
        self._kept: OrderedDict[tuple, list] = OrderedDict()
        self._lock = threading.Lock()
        self.hits = 0

    def warm_up(self) -> None:
        """Keeps the tables that requests read in memory, and answers the first page."""
        self.fact, self.core = self.fact.cache(), self.core.cache()
        self.call("code_summary", Filters())

    def source(self, name: str, f: Filters) -> DataFrame:
        """The core subset where every row the call reads is in it, else the fact."""
        return self.core if f.within_core(LEFT_OUT.get(name, ())) else self.fact

    def call(self, name: str, f: Filters, *args, **kw) -> list[dict]:
        key = (name, f, args, tuple(sorted(kw.items())))
        with self._lock:
            if key in self._kept:
                self._kept.move_to_end(key)
                self.hits += 1
                return self._kept[key]
        rows = CALLS[name](self.source(name, f), f, *args, **kw).limit(self.most_rows + 1).collect()
        if len(rows) > self.most_rows:
            raise ValueError(f"{name}: more than {self.most_rows} rows; ask for a page or export")
        out = [plain(r) for r in rows]
        with self._lock:
            self._kept[key] = out
            while len(self._kept) > self.most:
                self._kept.popitem(last=False)
        return out

    def meta(self) -> dict:
        (r,) = self.fact.agg(F.max("snapshot_date").alias("snapshot_date"), F.count(F.lit(1)).alias("n_rates"), F.count_distinct("npi").alias("n_npis")).collect()
        return plain(r)

    def health(self) -> dict:
        """Never raises."""
        try:
            return {"ok": True, "n_rates": self.fact.count()}
        except Exception as e:  # noqa: BLE001
            return {"ok": False, "error": str(e)[:300]}


def provenance(folder: str = ".") -> dict:
    """Commit of the code and whether it was changed since; unknown outside a repository."""

    def git(*args: str) -> str | None:
        r = subprocess.run(["git", "-C", folder, *args], capture_output=True, text=True, check=False)
        return r.stdout.strip() if r.returncode == 0 else None

    commit = git("rev-parse", "HEAD")
    return {"commit": commit, "dirty": bool(git("status", "--porcelain")) if commit else None}

"""Reading level of pages: a familiar-word formula with graded lists.

One list of frequent words can't order these levels where the easiest texts are rare: their words are then the least frequent
of all. So the lists are graded. Document frequencies per level come first from a bounded sample of labelled pages, then, by
classifying every page with these, from the whole corpus; a word belongs to the lowest level at which it is frequent. The
formula adds the shares of a page's listed words that lie above levels 1, 2 and 3 and its mean sentence length, with
coefficients fitted to the labelled sample. One pass reads the pages' prose and stores its words; the passes over these count
words in the tasks, so that no text is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricequarry.functions.columns import exact
from pricequarry.llm.prose import prose, sentences
from pricequarry.session import cut, fresh_folder

LEVELS = (1, 2, 3, 4)
LONGEST = 40.0  # words a sentence counts for at most


@dataclass
class Page:
    words: list[str]
    n_sentences: int

    @classmethod
    def of(cls, text: str | None) -> Page:
        s = sentences(prose(text))
        return cls([w.lower() for ws in s for w in ws], len(s))


@dataclass
class Model:
    levels: Mapping[str, int] = field(default_factory=dict)  # of listed words
    rows: Mapping[str, int] = field(default_factory=dict)  # of the first guess: where in log_odds a word is
    log_odds: np.ndarray | None = None  # log share of pages with the word, by level
    coefficients: np.ndarray | None = None
    cuts: tuple[float, ...] = (1.5, 2.5, 3.5)

    def guess(self, words: set[str]) -> int:
        """Naive Bayes over the words that the labelled pages have."""
        known = [v for w in words if (v := self.rows.get(w)) is not None]
        return LEVELS[int(np.argmax(self.log_odds[known].sum(axis=0)))] if known else 0

    def features(self, page: Page) -> np.ndarray:
        n = np.bincount([v for w in page.words if (v := self.levels.get(w))], minlength=5)[1:5]
        above = n[::-1].cumsum()[::-1] / max(1, n.sum())
        return np.array([1.0, above[1], above[2], above[3], min(LONGEST, len(page.words) / max(1, page.n_sentences)) / LONGEST])

    def score(self, page: Page) -> float:
        return float(self.features(page) @ self.coefficients)

    def band(self, score: float) -> int:
        return 1 + sum(score >= c for c in self.cuts)


def first_guess(pages: list[tuple[Page, int]]) -> Model:
    n = Counter(b for _, b in pages)
    df: dict[str, np.ndarray] = {}
    for page, band in pages:
        for w in set(page.words):
            df.setdefault(w, np.zeros(4))[band - 1] += 1
    size = np.array([n[b] for b in LEVELS], float)
    table = np.log((np.array(list(df.values())) + 0.1) / (size + 0.2))
    return Model(rows={w: n for n, w in enumerate(df)}, log_odds=table)


def graded(df: Mapping[str, np.ndarray], size: np.ndarray, frequent: float = 0.25, least: float = 0.001) -> dict[str, int]:
    """Level of each listed word: the lowest where its share of pages is ``frequent`` of its greatest share or more.

    Words in less than ``least`` of all pages (names, numbers) aren't listed, which bounds the list.
    """
    out = {}
    total = size.sum()
    for w, c in df.items():
        if c.sum() >= max(3, least * total) and not w[0].isdigit():
            share = (c + 0.0) / np.maximum(size, 1)
            out[w] = int(np.argmax(share >= frequent * share.max())) + 1
    return out


def fit(model: Model, pages: list[tuple[Page, int]], ridge: float = 0.05) -> np.ndarray:
    """Least squares on the labelled pages; twice, the second time without pages that are a level or more away (mislabelled)."""
    x = np.array([model.features(p) for p, _ in pages])
    y = np.array([b for _, b in pages], float)
    keep = np.ones(len(y), bool)
    for _ in range(2):
        a = x[keep]
        c = np.linalg.solve(a.T @ a + ridge * np.diag([0, 1, 1, 1, 1]), a.T @ y[keep])
        keep = np.abs(x @ c - y) < 0.8
    return c


def cut_points(scores: np.ndarray, bands: np.ndarray) -> tuple[float, ...]:
    """Between each two levels the cut with fewest labelled pages on the wrong side; of equals, the middle of the widest gap.

    Candidates lie within half a level of the middle, which is the cut where a level has no labelled page.
    """
    out = []
    for low in LEVELS[:-1]:
        middle = low + 0.5
        options = []
        if (bands == low).any() and (bands == low + 1).any():
            near = np.unique(np.r_[middle - 0.5, scores[np.abs(scores - middle) < 0.5], middle + 0.5])
            for a, b in zip(near[:-1], near[1:], strict=True):
                t = (a + b) / 2
                wrong = int(((scores >= t) & (bands <= low)).sum() + ((scores < t) & (bands > low)).sum())
                options.append((wrong, a - b, t))
        out.append(float(min(options)[2]) if options else middle)
    return tuple(out)


def calibrate(model: Model, pages: list[tuple[Page, int]]) -> None:
    model.coefficients = fit(model, pages)
    model.cuts = cut_points(np.array([model.score(p) for p, _ in pages]), np.array([b for _, b in pages]))


PAGES = pa.schema([("doc_id", pa.int64()), ("words", pa.string()), ("n_words", pa.int32()), ("n_sentences", pa.int32())])


def pages(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", language: str = "en", least_words: int = 60
) -> DataFrame:
    """(doc_id, words, n_words, n_sentences) of every page of the language with at least ``least_words`` words of prose, in lower case,
    stored in the shared folder. Null texts, other and null languages and pages with less prose have no row; repeated pages have
    a row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                page = Page.of(t.as_py())
                if len(page.words) >= least_words:
                    rows.append((i, " ".join(page.words), len(page.words), page.n_sentences))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 4, PAGES, strict=True)], schema=PAGES)

    documents = exact(documents, [doc_id, text, lang])
    rows = documents.filter((F.col(lang) == language) & F.col(text).isNotNull()).select(F.col(doc_id).cast("long"), F.col(text))
    folder = fresh_folder(documents.sparkSession, "pages")
    rows.mapInArrow(run, "doc_id long, words string, n_words int, n_sentences int").write.option("compression", "zstd").parquet(folder)
    return documents.sparkSession.read.parquet(folder)


def train(found: DataFrame, labels: DataFrame, doc_id: str = "doc_id", band: str = "band", most_labels: int = 20_000) -> Model:
    """The model from all ``pages`` and at most ``most_labels`` labelled ones (those of least doc_id; repeated labels: the median).

    Without any labelled page of enough prose the model is empty, and no page has a level.
    """
    given = exact(labels, [doc_id, band]).filter(F.col(band).between(1, 4)).groupBy(F.col(doc_id).cast("long").alias("k"))
    given = given.agg(F.floor(F.median(band) + 0.5).cast("int").alias("b"))
    bands = {r.k: r.b for r in given.orderBy("k").limit(most_labels).collect()}

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = pa.array([bands.get(i) for i in batch.column(0).to_pylist()], pa.int32())
            keep = b.is_valid()
            yield pa.RecordBatch.from_arrays([b.filter(keep), batch.column(1).filter(keep), batch.column(2).filter(keep)], names=["b", "words", "n"])

    rows = found.select("doc_id", "words", "n_sentences").mapInArrow(labelled, "b int, words string, n int").collect()
    sample = [(Page(r.words.split(), r.n), r.b) for r in rows]
    if not sample:
        return Model()
    guess = first_guess(sample)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: list[Counter[str]] = [Counter() for _ in LEVELS]
        n = [0] * 4

        def partial() -> pa.RecordBatch:
            words = sorted(set().union(*df))
            cols = [pa.array([n[i], *(df[i][w] for w in words)], pa.int64()) for i in range(4)]
            return pa.RecordBatch.from_arrays([pa.array([None, *words], pa.string()), *cols], names=["w", "c1", "c2", "c3", "c4"])

        for batch in batches:
            for words in batch.column(0).to_pylist():
                different = set(words.split())
                if b := guess.guess(different):
                    n[b - 1] += 1
                    df[b - 1].update(different)
            if sum(map(len, df)) > 400_000:
                yield partial()
                df, n = [Counter() for _ in LEVELS], [0] * 4
        yield partial()

    seen = found.select("words").mapInArrow(counts, "w string, c1 long, c2 long, c3 long, c4 long")
    seen = cut(seen.groupBy("w").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in LEVELS]))
    total = seen.filter("w is null").first()
    size = np.array([total[f"c{i}"] for i in LEVELS], float)
    often = seen.filter(F.col("w").isNotNull() & (F.col("c1") + F.col("c2") + F.col("c3") + F.col("c4") >= max(3, 0.001 * size.sum())))
    model = Model(levels=graded({r.w: np.array(r[1:], float) for r in often.toLocalIterator()}, size))
    calibrate(model, sample)
    return model


def reading_levels(found: DataFrame, model: Model) -> DataFrame:
    """(doc_id, band, score, n_words, n_sentences) of every row of ``pages``. An empty model gives no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(Page(w.split(), n)) for w, n in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            bands = pa.array([model.band(s) for s in scores], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), bands, pa.array(scores, pa.float64()), batch.column(2), batch.column(3)], names=["doc_id", "band", "score", "n_words", "n_sentences"])

    rows = found.select("doc_id", "words", "n_words", "n_sentences")
    if model.coefficients is None:
        rows = rows.limit(0)
    return rows.mapInArrow(run, "doc_id long, band int, score double, n_words int, n_sentences int")

"""A request's filters as an immutable value, compiled into column predicates.

Every filter is a specification: the form of its value, its default, the predicate it compiles to, and when one value of it
keeps no more rows than another. ``Filters`` only holds the values; what they restrict and which subset of the fact can serve
them follows from the specifications.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricequarry.functions.scalar import literal_contains

# Counting units and their columns, certainty of tags from low to high, kinds of tags, dollar prices.
UNITS = {"tin": "tin", "npi": "npi", "row": None}
CERTAINTY = ("medium", "high", "confirmed")
UNTAGGED = "none"
TAG_TYPES = ("platform", "health_system", UNTAGGED)
DOLLAR_TYPES = ("negotiated", "fee schedule")


@dataclass(frozen=True)
class Spec:
    """A setting that restricts nothing by itself, one of ``allowed``."""

    default: object
    allowed: Collection[str] | None = None

    def normal(self, v: object) -> object:
        if self.allowed is not None and v not in self.allowed:
            raise ValueError(f"{v!r} is none of {tuple(self.allowed)}")
        return v

    def predicate(self, v: object, f: Filters) -> Column | None:
        return None

    def narrows(self, mine: object, theirs: object) -> bool:
        """Whether every row that ``mine`` keeps is kept by ``theirs`` too."""
        return True


@dataclass(frozen=True)
class Choice(Spec):
    """Some of many values, none chosen: no restriction. ``holds`` says of the chosen ones whether a row has one."""

    default: tuple[str, ...] = ()
    holds: Callable[[list[str], Filters], Column] = lambda chosen, f: F.lit(True)

    def normal(self, v: object) -> tuple[str, ...]:
        chosen = {v} if isinstance(v, str) else {str(x) for x in v}
        if self.allowed is not None and (odd := chosen.difference(self.allowed)):
            raise ValueError(f"{sorted(odd)} are none of {tuple(self.allowed)}")
        return tuple(sorted(chosen))

    def predicate(self, v: tuple[str, ...], f: Filters) -> Column | None:
        return self.holds(list(v), f) if v else None

    def narrows(self, mine: tuple[str, ...], theirs: tuple[str, ...]) -> bool:
        return not theirs or (bool(mine) and set(mine) <= set(theirs))


@dataclass(frozen=True)
class Toggle(Spec):
    """A condition, in force or not; rows for which it is null are dropped."""

    condition: Callable[[Filters], Column] = lambda f: F.lit(True)
    market_only: bool = False

    def predicate(self, v: bool, f: Filters) -> Column | None:
        return self.condition(f) if v else None

    def narrows(self, mine: bool, theirs: bool) -> bool:
        return mine or not theirs


@dataclass(frozen=True)
class Search(Spec):
    """Text that one of the columns contains, in any case."""

    default: str = ""
    columns: tuple[str, ...] = ()

    def predicate(self, v: str, f: Filters) -> Column | None:
        return any_of(literal_contains(F.col(c), v) for c in self.columns) if v.strip() else None

    def narrows(self, mine: str, theirs: str) -> bool:
        return theirs.strip().upper() in mine.strip().upper()


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def among(column: str) -> Choice:
    return Choice(holds=lambda chosen, f: F.col(column).isin(chosen))


def sharing(column: str) -> Choice:
    return Choice(holds=lambda chosen, f: F.arrays_overlap(F.col(column), F.array(*[F.lit(x) for x in chosen])))


def of_tag_type(chosen: list[str], f: Filters) -> Column:
    kind = f.tag("tag_type")
    return any_of(kind.isNull() if x == UNTAGGED else kind == x for x in chosen)


def kept_if(condition: str, default: bool = True) -> Toggle:
    return Toggle(default, condition=lambda f: F.expr(condition))


SPECS: Mapping[str, Spec] = {
    "codes": among("billing_code"),
    "provider_types": among("provider_type"),
    "states": among("practice_state"),
    "cities": among("practice_city"),
    "zips": among("practice_zip5"),
    "tins": among("tin"),
    "npis": among("npi"),
    "networks": sharing("networks"),
    "places_of_service": sharing("service_code"),
    "pos_groups": among("pos_group"),
    "billing_classes": Choice(("professional",), holds=lambda chosen, f: F.col("billing_class").isin(chosen)),
    "tag_types": Choice(allowed=TAG_TYPES, holds=of_tag_type),
    "tag_names": Choice(holds=lambda chosen, f: f.tag().isin(chosen)),
    "search": Search(columns=("npi", "tin", "provider_name", "tin_search")),
    "exclude_zero": kept_if("not is_zero_rate"),
    "exclude_invalid_npi": kept_if("is_valid_npi"),
    "in_state_only": kept_if("is_in_state_any"),
    "dollar_rates_only": kept_if(f"rate_unit = 'dollars' and negotiated_type in {DOLLAR_TYPES}"),
    "exclude_expired": kept_if("not is_expired"),
    "expected_scope_only": kept_if("scope_flag = 'expected'"),
    "exclude_platforms_from_market": Toggle(False, condition=lambda f: ~f.tag("tag_type").eqNullSafe("platform"), market_only=True),
    "min_tag_confidence": Spec("high", CERTAINTY),
    "counting_unit": Spec("tin", UNITS),
}


class Filters:
    """The values of a request, by name as in ``SPECS``; what isn't given has its default. Equal values are equal and hash alike."""

    __slots__ = ("_values",)

    def __init__(self, **given: object) -> None:
        if odd := given.keys() - SPECS.keys():
            raise TypeError(f"no such filters: {sorted(odd)}")
        values = {name: spec.normal(given[name]) if name in given else spec.default for name, spec in SPECS.items()}
        object.__setattr__(self, "_values", values)

    @classmethod
    def from_mapping(cls, given: Mapping[str, object] | None) -> Filters:
        """From what a caller sent: names that aren't filters are ignored."""
        return cls(**{name: (given or {})[name] for name in SPECS.keys() & (given or {}).keys()})

    def __getattr__(self, name: str) -> object:
        if name in SPECS:
            return self._values[name]
        raise AttributeError(name)

    def __setattr__(self, name: str, value: object) -> None:
        raise AttributeError("filters don't change; ask for others with but()")

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Filters) and self._values == other._values

    def __hash__(self) -> int:
        return hash(tuple(self._values.values()))

    def __repr__(self) -> str:
        return f"Filters({', '.join(f'{k}={v!r}' for k, v in self._values.items() if v != SPECS[k].default)})"

    def __iter__(self) -> Iterator[tuple[str, object]]:
        return iter(self._values.items())

    def __reduce__(self) -> tuple:
        return Filters.from_mapping, (self._values,)

    def but(self, **changes: object) -> Filters:
        return Filters(**{**self._values, **changes})

    def tag(self, column: str = "tag_name") -> Column:
        """A tag column, null where the tag is less certain than asked."""
        sure = CERTAINTY[CERTAINTY.index(self.min_tag_confidence) :]
        return F.when(F.col("tag_confidence").isin(*sure), F.col(column))

    def predicates(self, ignore: Iterable[str] = (), market: bool = False) -> dict[str, Column]:
        """The predicate of each filter in force. ``market`` adds those that only shape the market that is compared with."""
        left = {name: v for name, v in self if name not in set(ignore) and (market or not getattr(SPECS[name], "market_only", False))}
        compiled = {name: SPECS[name].predicate(v, self) for name, v in left.items()}
        return {name: p for name, p in compiled.items() if p is not None}

    def apply(self, fact: DataFrame, ignore: Iterable[str] = (), market: bool = False) -> DataFrame:
        for p in self.predicates(ignore, market).values():
            fact = fact.filter(p)
        return fact

    def narrows(self, other: Filters, ignore: Iterable[str] = ()) -> bool:
        """Whether every row that these filters keep, those in ``ignore`` left out, is kept by ``other``."""
        asked = other.predicates(market=True).keys()
        if asked & {"tag_types", "tag_names", "exclude_platforms_from_market"} and self.min_tag_confidence != other.min_tag_confidence:
            return False
        return not asked & set(ignore) and all(SPECS[name].narrows(getattr(self, name), getattr(other, name)) for name in asked)

    def within_core(self, ignore: Iterable[str] = ()) -> bool:
        """Whether the core subset may be read in place of the fact."""
        return self.narrows(CORE, ignore)


# The filter that a group's key leads into.
DRILL_DOWN = {
    "billing_code": "codes", "tin": "tins", "npi": "npis", "network": "networks", "provider_type": "provider_types", "pos_group": "pos_groups", "tag": "tag_names", "practice_state": "states",
    "practice_city": "cities", "practice_zip5": "zips",
}


def drilled(f: Filters, group: Mapping[str, object]) -> Filters:
    """The request for the rows behind a group of a summary; keys without a filter, and null ones, restrict nothing."""
    return f.but(**{DRILL_DOWN[k]: str(v) for k, v in group.items() if k in DRILL_DOWN and v is not None})


CORE = Filters(dollar_rates_only=False)  # what most requests read: the default filters, in all units of price


def core_subset(fact: DataFrame) -> DataFrame:
    return CORE.apply(fact)

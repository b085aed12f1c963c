"""Keys whose typed names show one owner: MinHash banding, Monge-Elkan verification, star clustering.

1. Which words are common, and what they tell, is learned from all names; names are parsed (names.py) and reduced to distinct
   parsed names, these to distinct cores.
2. Cores are banded: MinHash over padded q-grams, with as many bands as the collision curve 1 - (1 - s^rows)^bands asks for at
   the least similarity to be found. Buckets give candidate pairs of cores, once each, verified by Monge-Elkan similarity.
   A bucket that more than ``chunk`` cores share is not paired off: its cores meet by the spellings of their words, which loses
   no similar pair, see ``near_pairs``.
3. Star clustering of cores: by rounds, a core that outranks all free neighbours (by degree, then by lot) becomes a centre and
   takes its free neighbours. Rounds are written to the shared folder.
4. Within a star, parsed names, the centre's own and heavy ones first, are linked to the owners that they agree with; a star of
   very many names is taken in parts, whose owners are then linked alike. Other names of equal or similar cores, in one star or
   in two, are compared too, so that no link is lost to the choice of centres, parts or owners.
5. Keys sharing an owner are connected by alternating large and small stars, in a number of rounds that grows with the logarithm of
   the longest chain; a key's names that stand in for its own are dropped before.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricequarry.functions.columns import exact
from pricequarry.llm.names import LONG_CORE, PLAIN, Name, Vocabulary, same_core, word_counts
from pricequarry.session import cut

Q = 3
PRIME = (1 << 61) - 1


def bands_for(similarity: float, recall: float, rows: int) -> int:
    """The least number of bands of ``rows`` hashes with which sets of that Jaccard similarity collide with that chance."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def qgrams(core: str, q: int = Q) -> set[str]:
    """Of each word, padded at both ends."""
    return {f"{'^' * (q - 1)}{w}{'$' * (q - 1)}"[i : i + q] for w in core.split() for i in range(len(w) + q - 1)}


def _hash(gram: str) -> int:
    h = 1469598103934665603
    for b in gram.encode():
        h = ((h ^ b) * 1099511628211) & 0xFFFFFFFFFFFFFFFF
    return h


class MinHash:
    """Band values of a core; the same on every machine."""

    def __init__(self, bands: int, rows: int, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.a = rng.integers(1, 1 << 32, bands * rows, dtype=np.uint64) | np.uint64(1)
        self.b = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
        self.bands, self.rows = bands, rows
        self.mix = rng.integers(1, 1 << 62, rows, dtype=np.uint64) | np.uint64(1)
        self.grams: dict[str, int] = {}

    def __call__(self, core: str) -> np.ndarray:
        if len(self.grams) > 1 << 20:
            self.grams.clear()
        x = np.array([self.grams.get(g) or self.grams.setdefault(g, _hash(g)) for g in qgrams(core)], dtype=np.uint64)
        with np.errstate(over="ignore"):
            x = (x ^ (x >> np.uint64(31)))[None, :] * self.a[:, None] + self.b[:, None]
            low = (x ^ (x >> np.uint64(29))).min(axis=1).reshape(self.bands, self.rows)
            h = (low * self.mix).sum(axis=1, dtype=np.uint64)
            return ((h ^ (h >> np.uint64(33))) * np.uint64(0x9E3779B97F4A7C15) + np.arange(self.bands, dtype=np.uint64)).astype(np.int64)


def vocabulary(names: DataFrame, name: str = "name") -> Vocabulary:
    """The common words of all names. Those that come to the driver are in one name of a thousand at least, so that they are a few
    thousand at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            found = word_counts(texts)
            yield pa.RecordBatch.from_arrays([pa.array([None, *found], pa.string()), pa.array([len(texts), *found.values()], pa.int64())], names=["word", "n"])

    distinct = names.select(F.col(name).alias("name")).filter("name is not null").distinct()
    counts = cut(distinct.repartition(tasks(names), "name").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))
    total = counts.filter("word is null").first()
    if total is None:
        return PLAIN
    often = counts.filter(F.col("word").isNotNull() & (F.col("n") >= 0.001 * total.n)).collect()
    return Vocabulary.learned({r.word: r.n for r in often}, total.n)


def parsed(names: DataFrame, known: Vocabulary = PLAIN, name: str = "name") -> DataFrame:
    """``names`` with node (the parsed name as text), core, kind and given; names without a core are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            found = [known.parse(t) for t in texts]
            keep = [(t, p) for t, p in zip(texts, found, strict=True) if p]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.string()) for x in ([t for t, _ in keep], [p.text() for _, p in keep], [" ".join(p.core) for _, p in keep], [p.kind for _, p in keep], [p.given for _, p in keep])],
                names=["name", "node", "core", "kind", "given"],
            )

    distinct = names.select(F.col(name).alias("name")).filter("name is not null").distinct()
    return distinct.repartition(tasks(names), "name").mapInArrow(run, "name string, node string, core string, kind string, given string")


def counted_by(rows: DataFrame, key: str, n: str, least: int = 1) -> DataFrame:
    """``rows`` with the number of rows that have their ``key``, where that is at least ``least``. The numbers are counted before they
    are joined, so that no task needs all rows of one key."""
    return rows.join(rows.groupBy(key).agg(F.count(F.lit(1)).alias(n)).filter(F.col(n) >= least), key)


def may_agree(a: Column, b: Column) -> Column:
    """False only where ``same_core`` can't hold: single words, neither the beginning of the other, too many edits apart (a
    swap of neighbours is two). Checked where the pairs arise, so that those that met by chance go no further."""
    near = F.levenshtein(a, b, 4).between(0, F.when(F.greatest(F.length(a), F.length(b)) >= LONG_CORE, 4).otherwise(2))
    return near | a.contains(" ") | b.contains(" ") | a.startswith(b) | b.startswith(a)


def banded(cores: DataFrame, similarity: float, recall: float, rows: int) -> DataFrame:
    """(core, bucket, n): the band values of each core that others share, with the number of cores that do."""
    bands = bands_for(similarity, recall, rows)
    minhash = MinHash(bands, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            if not texts:
                continue
            values = np.concatenate([minhash(t) for t in texts])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(texts, dtype=object), bands), pa.string()), pa.array(values)], names=["core", "bucket"])

    rows_ = cores.select("core").repartition(tasks(cores), "core").mapInArrow(run, "core string, bucket long")
    return counted_by(rows_, "bucket", "n", 2)


def band_pairs(cores: DataFrame, similarity: float = 0.45, recall: float = 0.95, rows: int = 4, chunk: int = 64) -> DataFrame:
    """(a, b), a < b: cores that share a band value with up to ``chunk`` cores and may agree, each pair once. The pairs of larger
    buckets are those of ``near_pairs``; ``candidates`` gives both."""
    return _small(banded(cores, similarity, recall, rows), chunk)


def _small(buckets: DataFrame, chunk: int) -> DataFrame:
    few = buckets.filter(F.col("n") <= chunk).select("bucket", "core")
    cond = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.core") < F.col("y.core"))
    pairs = few.alias("x").join(few.alias("y"), cond).select(F.col("x.core").alias("a"), F.col("y.core").alias("b"))
    return pairs.filter(may_agree(F.col("a"), F.col("b"))).distinct()


def candidates(cores: DataFrame, similarity: float = 0.45, recall: float = 0.95, rows: int = 4, chunk: int = 64) -> DataFrame:
    """(a, b), a < b: the pairs of cores that share a band value, each once, but for some of which ``same_core`` can't hold."""
    buckets = banded(cores, similarity, recall, rows)
    crowded = buckets.filter(F.col("n") > chunk).select("core").distinct()
    return _small(buckets, chunk).unionByName(near_pairs(crowded)).distinct()


SHORT = 26  # up to here a word's spellings with two letters left out are listed, beyond only those of its ends
END = 10


def spellings(word: str) -> set[tuple[str, bool]]:
    """(key, whole): words of which ``alike_core`` is not 0 have a key in common that is whole for one of them.

    Words few edits apart are equal when each leaves out as many letters (a swap is one). Of long words either the first or the
    last letters hold at most one of two edits. The beginnings of a word are keys that are whole for that beginning only.
    """
    n, out = len(word), set()
    if n <= SHORT:
        left = {word}
        for _ in range(2 if n >= LONG_CORE - 2 else 1):
            left |= {w[:i] + w[i + 1 :] for w in left for i in range(len(w))}
        out = {(f"-{w}", True) for w in left}
    if n >= SHORT - 1:
        out |= {(f"{side}{w[:i]}{w[i + 1 :]}", True) for side, w in (("^", word[:END]), ("$", word[-END:])) for i in range(END)}
    return out | {(f"+{word[:i]}", i == n) for i in range(6, min(n, SHORT) + 1)}


def near_pairs(cores: DataFrame, least: float = 0.78, block: int = 1024) -> DataFrame:
    """(a, b), a < b: every pair of the cores that may reach ``least`` in ``same_core``, each once, and few others.

    For a similarity of ``least`` each core needs a partner for all but a share of 1 - ``least`` of its words, so that one more
    than that, its rarest, are looked up among all words of the others by their ``spellings``. Cores that have a spelling in
    common are compared in blocks of ``block`` with all the others, so no task gets them all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for core, word, own in zip(*[batch.column(n).to_pylist() for n in range(3)], strict=True):
                rows += [(core, own, key, whole) for key, whole in spellings(word)]
                if len(rows) >= 5000:
                    yield build(rows)
                    rows = []
            if rows:
                yield build(rows)

    def build(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.bool_(), pa.string(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["core", "own", "key", "whole"])

    words = cores.select("core", F.explode(F.array_distinct(F.split("core", " "))).alias("word"))
    words = counted_by(words, "word", "often")
    by = Window.partitionBy("core")
    words = words.withColumn("place", F.row_number().over(by.orderBy("often", F.desc(F.length("word")), "word"))).withColumn("size", F.count(F.lit(1)).over(by))
    words = words.select("core", "word", (F.col("place") <= F.floor(F.col("size") * (1 - least) + 1e-9) + 1).alias("own"))
    keys = words.repartition(tasks(cores), "core", "word").mapInArrow(run, "core string, own boolean, key string, whole boolean")
    keys = keys.select("core", "own", "whole", F.xxhash64("key").alias("key"))
    keys = counted_by(keys, "key", "n", 2)
    keys = keys.withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    x = keys.filter("own").withColumn("part", F.pmod(F.hash("core"), "blocks")).alias("x")
    y = keys.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).alias("y")
    once = F.when(F.col("y.own"), F.col("x.core") < F.col("y.core")).otherwise(F.col("x.core") != F.col("y.core"))
    met = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.part") == F.col("y.part")) & once & (F.col("x.whole") | F.col("y.whole")))
    met = met.select(F.least("x.core", "y.core").alias("a"), F.greatest("x.core", "y.core").alias("b"))
    return met.filter(may_agree(F.col("a"), F.col("b"))).distinct()


def similar_cores(pairs: DataFrame, least: float = 0.78) -> DataFrame:
    """The candidate pairs whose Monge-Elkan similarity reaches ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = [same_core(tuple(x.split()), tuple(y.split()), least) for x, y in zip(a, b, strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b").repartition(tasks(pairs), "a", "b").mapInArrow(run, "a string, b string")


def stars(cores: DataFrame, edges: DataFrame) -> DataFrame:
    """(core, center) of every core: star clustering along edges (a, b).

    In each round every free core that outranks its free neighbours, by (degree, lot, text), becomes a centre and its free
    neighbours its satellites, each with the centre that ranks highest. A core without neighbours is its own centre. The core
    ranking highest of all is always a centre, so every round ends some, and with lots for ranks half of what is left.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ranked = both.groupBy(F.col("a").alias("core")).agg(F.count(F.lit(1)).alias("degree"))
    ranked = ranked.select("core", F.struct("degree", F.xxhash64("core").alias("lot"), "core").alias("rank"))
    links = both.join(ranked.withColumnRenamed("core", "a").withColumnRenamed("rank", "rank_a"), "a")
    links = cut(links.join(ranked.withColumnRenamed("core", "b").withColumnRenamed("rank", "rank_b"), "b").select("a", "b", "rank_a", "rank_b"))
    out = edges.select(F.col("a").alias("core"), F.col("a").alias("center")).limit(0)
    while not links.isEmpty():
        top = links.groupBy("a").agg(F.max("rank_b").alias("best"), F.first("rank_a").alias("own"))
        centers = top.filter(F.col("own") > F.col("best")).select(F.col("a").alias("c"))
        taken = links.join(centers, F.col("b") == F.col("c"), "left_semi").groupBy(F.col("a").alias("core")).agg(F.max("rank_b").alias("r"))
        found = cut(taken.select("core", F.col("r.core").alias("center")).unionByName(centers.select(F.col("c").alias("core"), F.col("c").alias("center"))))
        out = out.unionByName(found)
        gone = found.select("core")
        left = links.join(gone.withColumnRenamed("core", "a"), "a", "left_anti").join(gone.withColumnRenamed("core", "b"), "b", "left_anti")
        links = cut(left)
    lone = cores.select("core").join(out, "core", "left_anti").select("core", F.col("core").alias("center"))
    return out.unionByName(lone)


OWNED = pa.schema([("center", pa.string()), ("node", pa.string()), ("owner", pa.string())])


def _owners(known: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Parsed names, group by group, in order: each is linked to every owner of its group it agrees with, or becomes one."""
        group, owners = None, []
        for batch in batches:
            rows = []
            for center, part, node in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (center, part) != group:
                    group, owners = (center, part), []
                mine = Name.of(node)
                homes = [c for c, other in owners if known.same_owner(mine, other)]
                if not homes:
                    homes = [node]
                    owners.append((node, mine))
                rows += [(center, node, home) for home in homes]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (zip(*rows, strict=True) if rows else [[]] * 3)], schema=OWNED)

    return run


def tasks(df: DataFrame) -> int:
    """How many tasks the Python stages take: their rows are few bytes but much work, so sizes in bytes don't tell."""
    spark = df.sparkSession
    return max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def owners(names: DataFrame, known: Vocabulary = PLAIN, part_of: int = 5000) -> DataFrame:
    """(node, owner) for parsed names with node, core and weight: the clusters of names, and the links between them."""
    nodes = cut(names.groupBy("node", "core").agg(F.sum("weight").alias("weight")))
    cores = nodes.select("core").distinct()
    edges = cut(similar_cores(candidates(cores)))
    star = cut(stars(cores, edges))
    found = cut(star_owners(nodes, star, known, part_of))
    return found.unionByName(bridges(nodes, edges, star, found, known))


def star_owners(nodes: DataFrame, star: DataFrame, known: Vocabulary, part_of: int) -> DataFrame:
    """(node, owner) within stars. A star of more than ``part_of`` names is taken in parts; the owners of its parts are linked to
    each other in a second step, so no task goes through all its names."""
    placed = nodes.join(star, "core").select("center", "node", "weight", (F.col("core") == F.col("center")).alias("inner"))
    large = placed.groupBy("center").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > part_of)
    parts = F.coalesce(F.ceil(F.col("n") / part_of), F.lit(1)).cast("int")
    placed = placed.join(large, "center", "left").withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int"))
    spread = placed.repartition(tasks(nodes), "center", "part").sortWithinPartitions("center", "part", F.desc("inner"), F.desc("weight"), "node")
    ddl = "center string, node string, owner string"
    found = cut(spread.select("center", "part", "node").mapInArrow(_owners(known), ddl))
    again = found.join(large, "center", "left_semi").select("center", F.lit(0).alias("part"), F.col("owner").alias("node")).distinct()
    again = again.repartition(tasks(nodes), "center").sortWithinPartitions("center", "node").mapInArrow(_owners(known), ddl)
    return found.unionByName(again).select("node", "owner")


def bridges(nodes: DataFrame, edges: DataFrame, star: DataFrame, found: DataFrame, known: Vocabulary = PLAIN) -> DataFrame:
    """(node, owner) links that stars would lose: a core similar to two centres is in one star only, and within a star names are
    compared with owners only. So names of similar cores in different stars are compared one by one, and names of equal or
    similar cores in one star unless they have an owner in common."""
    a, b = star.toDF("a", "center_a"), star.toDF("b", "center_b")
    alike = edges.join(a, "a").join(b, "b").select("a", "b", (F.col("center_a") == F.col("center_b")).alias("within"))
    alike = alike.unionByName(star.select(F.col("core").alias("a"), F.col("core").alias("b"), F.lit(True).alias("within")))
    kind, given = F.split_part("node", F.lit("|"), F.lit(1)), F.substring(F.split_part("node", F.lit("|"), F.lit(4)), 1, 1)
    homes = found.groupBy("node").agg(F.collect_set("owner").alias("homes"))
    named = cut(nodes.join(homes, "node").select("core", "node", "homes", F.concat_ws("|", kind, F.when(kind == "person", given)).alias("block")))
    left, right = named.toDF("a", "x", "homes_x", "block"), named.toDF("b", "y", "homes_y", "block")
    met = alike.join(left, "a").join(right, ["b", "block"]).filter((F.col("a") != F.col("b")) | (F.col("x") < F.col("y")))
    met = met.filter(~(F.col("within") & F.arrays_overlap("homes_x", "homes_y"))).select("x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [known.same_owner(Name.of(x), Name.of(y)) for x, y in zip(*[batch.column(n).to_pylist() for n in (0, 1)], strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    agreed = met.repartition(tasks(nodes), "x", "y").mapInArrow(run, "x string, y string")
    return agreed.join(found.select(F.col("node").alias("y"), "owner"), "y").select(F.col("x").alias("node"), "owner")


def components(links: DataFrame) -> DataFrame:
    """(key, component) of the links (key, owner): the least key that can be reached.

    Keys of one owner become edges to the least of them. Then, by turns, every key sends its larger neighbours to the least key it
    knows of (large star), and its smaller ones and itself (small star), until nothing changes: that takes rounds in the
    order of the logarithm of the longest chain, and no key's neighbours are ever gathered. Written out each round.
    """
    pairs = cut(links.select("key", "owner").distinct())
    low = pairs.groupBy("owner").agg(F.min("key").alias("v"))
    edges = cut(pairs.join(low, "owner").filter("key <> v").select(F.col("key").alias("u"), "v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.withColumnRenamed("m", "v"))
        edges = cut(small.distinct())
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
    keys = pairs.select("key").distinct()
    return keys.join(edges.withColumnRenamed("u", "key"), "key", "left").select("key", F.coalesce("v", "key").alias("component"))


def linked_keys(names: DataFrame, individuals: DataFrame) -> DataFrame:
    """(key, component): keys of the same owner share a component.

    ``names``: (key, name) rows, repeated as often as they stand; null keys and names are ignored. ``individuals``: (last_name,
    first_name) of registered clinicians: a personal name of a key that has other kinds of names, or that is a registered
    clinician's, only stands in for the owner's and links nothing. An empty table gives no row. Keys without a usable name
    have no component.
    """
    names, individuals = exact(names, ["key", "name"]), exact(individuals, ["last_name", "first_name"])
    counted = names.filter("key is not null and name is not null").groupBy("key", "name").agg(F.count(F.lit(1)).alias("weight"))
    known = vocabulary(counted)
    counted = cut(counted.join(parsed(counted, known), "name").select("key", "node", "core", "kind", "given", "weight"))
    people = individuals.filter("last_name is not null and first_name is not null").select(F.concat_ws(" ", "last_name", "first_name").alias("name"))
    people = parsed(people, known).filter("kind = 'person'").select("core", F.explode(F.array("given", F.substring("given", 1, 1))).alias("given")).distinct()
    is_org = F.max(F.when(F.col("kind") == "org", 1).otherwise(0)).over(Window.partitionBy("key"))
    stands_in = counted.withColumn("has_org", is_org).filter("kind = 'org' or has_org = 0")
    own = stands_in.filter("kind = 'org'").unionByName(stands_in.filter("kind <> 'org'").join(people, ["core", "given"], "left_anti").select(*stands_in.columns))
    own = cut(own.drop("has_org"))
    return components(own.select("key", "node").join(owners(own, known), "node").select("key", "owner"))


def key_pairs(linked: DataFrame) -> DataFrame:
    """(key_a, key_b): every pair of keys of one component, smaller first."""
    a, b = linked.select(F.col("key").alias("key_a"), "component"), linked.select(F.col("key").alias("key_b"), "component")
    return a.join(b, "component").filter("key_a < key_b").select("key_a", "key_b")

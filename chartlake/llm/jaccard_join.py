"""Exact self-join of word-shingle sets under the Jaccard metric, as components.

Jaccard distance is a metric, and linked documents are within ``1 - percent /
100`` of each other. Unrelated documents, however, are all at distance exactly
1 from each other and from any pivot document, so document pivots alone can't
tell them apart. The first cut is therefore made in other (pseudo-)metrics on
the same sets: the sizes of the symmetric differences within hash slices of
the shingle space. They add up to the whole symmetric difference, which is at
most D for a linked pair of a size level; cut into more than D slices, a linked
pair has a slice at distance 0. So every distinct content of a slice is a pivot
whose Voronoi region of radius 0 holds all documents with that content, and
every linked pair shares a region. Sizes are the distances to the empty set:
by the triangle inequality a document is replicated only into the size level
above its own, and only if that is within reach.

With a few slices more, linked pairs share ``SHARED`` regions. Documents that
share so many, or one region of very many documents, directly or through others,
make a cluster; no link leaves a cluster. Two documents that share small regions
are only counted if a sketch of their sets (a parity for each of some hash slices;
no more of them differ than shingles do) leaves a link possible. Clusters of up to ``SMALL`` documents are joined in
one task each (many to a task). Larger ones are cut by document pivots: every
document is measured against some pivots of its cluster exactly, goes to the
region of the nearest one, and is replicated to each other region whose pivot
is at most twice the linking distance farther, which by the triangle inequality
puts every linked pair into a region together. Regions are cut again in the
same way as long as that lessens the work. What stays large (documents about
equally far from each other) is cut into blocks by size, and blocks meet in
pairs unless their sizes, the distances to the empty set, rule links out. A
task measures all pairs of its two blocks and returns only links that join
parts not joined before, so a group of n near copies gives n links, not n^2.
No link between different texts is missed and none is assumed.

Equal sets are one class from the start, and a class is joined by its smallest
id. Shingles are 64-bit hashes of word hashes.

Defined results: null, empty and word-free texts have empty sets and link with
nothing; texts with fewer words than a shingle are one shingle; rows with a null or
repeated id are told apart, each linked by its own text; a component with no id
other than null has a null component_id; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, measured, saved
from .components import components
from .words import chain, chunks, hashes, mix, split_words

WORDS, PERCENT = 4, 85
#: Documents that one task compares pair by pair; twice as many when two blocks meet.
SMALL = 1024
#: Pivots of one cut, and cuts within cuts, at most; blocks do the rest.
PIVOTS, DEPTH = 64, 3
#: Regions that linked documents share at least, and the size up to which all
#: pairs of a region are counted; of larger regions all documents are taken.
SHARED, COUNTED = 3, 128
#: Longs of a sketch, 64 parities each.
SKETCH = 4
#: Hashes by which a set is sliced until few slices are empty.
TRIES = 6


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    found, codes, offsets = split_words(texts)
    h = hashes(found)[codes] if len(codes) else np.zeros(0, np.uint64)
    n = len(h) - words + 1
    every = chain([h[i:i + n] for i in range(words)]) if n > 0 else np.zeros(0, np.uint64)
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= words:
            yield np.unique(every[a:b - words + 1])
        elif b > a:
            yield chain([h[i:i + 1] for i in range(a, b)])
        else:
            yield np.zeros(0, np.uint64)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parities of the shingles in hash slices: two sets differ by as many shingles at least as bits differ."""
    at = (mix(shingles) % np.uint64(64 * SKETCH)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=64 * SKETCH) & 1).astype(np.uint8)).view(np.int64)


class Slicing:
    """Size levels and the slices of each for one threshold."""

    def __init__(self, percent: int):
        if not 50 <= percent <= 100:
            raise ValueError("percent must be from 50 to 100")
        self.percent = percent
        self.ratio = max(1.25, 105 / percent)
        edges = [1]
        while edges[-1] < 1 << 40:
            edges.append(max(edges[-1] + 1, math.ceil(edges[-1] * self.ratio)))
        self.edges = np.array(edges)

    def levels(self, n: int) -> list[int]:
        """The level of size n, and the next if a partner there can be linked."""
        own = int(np.searchsorted(self.edges, n, side="right")) - 1
        return [own, own + 1] if 100 * n >= self.percent * int(self.edges[own + 1]) else [own]

    def difference(self, level: int) -> int:
        """The most by which linked sets differ if the larger is of this level."""
        return 2 * (int(self.edges[level + 1]) - 1) * (100 - self.percent) // (100 + self.percent)

    def slices(self, level: int) -> tuple[int, int]:
        """How many slices a level has, and on how many of them linked sets agree at least.

        About as many more than needed as a small set of the level leaves empty.
        """
        most, least = self.difference(level), self.percent * int(self.edges[level]) / 100
        agree, cap = SHARED, most + 2 + SHARED
        while (want := int((most + agree) * math.exp(-least / (most + agree))) + 2 + SHARED) > agree and agree < cap:
            agree = min(want, cap)
        return most + agree, agree

    def signatures(self, shingles: np.ndarray, seed: int) -> np.ndarray:
        """A hash for each (level, slice, content); linked sets that differ share SHARED.

        Contents of no shingle don't count at first: unless both sets leave
        nearly as many slices empty as linked sets agree on, they share SHARED
        that aren't. Sets that do are sliced again by another hash, and only
        those that do in every try count their empty slices as contents.
        """
        out = []
        for level in self.levels(len(shingles)):
            if not self.difference(level):
                continue  # only equal sets are linked; these are one class
            slices, agree = self.slices(level)
            for again in range(TRIES):
                salt = np.uint64((seed * TRIES + again) * 0x9E3779B97F4A7C15 % (1 << 64))
                spread = mix(shingles + salt)
                at = (spread % np.uint64(slices)).astype(np.int64)
                content = np.zeros(slices, np.uint64)
                np.add.at(content, at, mix(spread))
                filled = np.bincount(at, minlength=slices) > 0
                sparse = (~filled).sum() > agree - SHARED
                names = np.arange(slices) if sparse and again == TRIES - 1 else np.flatnonzero(filled)
                out.append(chain([np.full(len(names), np.uint64(level * TRIES + again)),
                                  names.astype(np.uint64), content[names]]))
                if not sparse:
                    break
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _scan(docs: DataFrame, words: int) -> DataFrame:
    """Stored (id, n, key, sketch) of every row: the size, a 128-bit hash and a sketch of its set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 1):
                sets = list(shingle_sets(part.column(1), words))
                keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                     pa.array([sketch(s) for s in sets], pa.list_(pa.int64()))],
                    names=["id", "n", "key", "sketch"])

    kind = docs.schema["id"].dataType.simpleString()
    return saved(docs.mapInArrow(run, f"id {kind}, n long, key binary, sketch array<long>"), "sets-scanned")


def _regions(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(region, id) of the documents. Texts are read again for this: the
    signatures are too many to store beside their shuffle."""
    slicing = Slicing(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 1):
                sigs = [slicing.signatures(s, 0).view(np.int64) if len(s) else []
                        for s in shingle_sets(part.column(1), words)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sigs, pa.list_(pa.int64()))],
                                                 names=["id", "sigs"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, sigs array<long>").select(F.explode("sigs").alias("region"), "id")


def _sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """Stored (id, s): the shingles of the given documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 1):
                sets = [s.view(np.int64) for s in shingle_sets(part.column(1), words)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "s"])

    kind = docs.schema["id"].dataType.simpleString()
    wanted = measured(ids.select(F.col("id").alias("__id")))
    rows = docs.join(wanted, F.col("id") == F.col("__id"), "left_semi")
    return saved(rows.mapInArrow(run, f"id {kind}, s array<long>"), "sets")


def _chained(led: DataFrame) -> DataFrame:
    """Stored pairs that connect the same documents as ``led`` (a, b): each a with the first of
    its b, and that with the next. Documents of a group have much the same b, so this is about
    a pair a document, and not one for each of its regions."""
    of = led.groupBy("a").agg(F.array_sort(F.collect_set("b")).alias("leads"))
    pair = F.explode(F.expr("arrays_zip(slice(leads, 2, size(leads)), slice(leads, 1, size(leads) - 1))")).alias("pair")
    steps = of.where(F.size("leads") > 1).select(pair).select(F.col("pair")["0"].alias("a"), F.col("pair")["1"].alias("b"))
    return saved(of.select("a", F.col("leads")[0].alias("b")).union(steps.distinct()), "led")


def _near(percent: int):
    """Whether the sizes and sketches of two rows (n, sketch) and (__n, __sketch) leave a link possible:
    linked sets differ by at most (100 - percent) / (100 + percent) of their sizes together."""
    bits = functools.reduce(lambda x, y: x + y, [F.bit_count(F.col("sketch")[i].bitwiseXOR(F.col("__sketch")[i]))
                                                 for i in range(SKETCH)])
    return ((100 + percent) * F.greatest(bits.cast("long"), F.abs(F.col("n") - F.col("__n")))
            <= (100 - percent) * (F.col("n") + F.col("__n")))


def _shared(regions: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Stored pairs (a, b) that connect all documents which may be linked.

    A pair that is linked shares SHARED regions: either one of them is large,
    and both are connected to that region's smallest id, or all are small, and
    it is counted there. First each document is counted with the smallest ids
    of its regions alone, so a group of copies becomes one part by as many
    pairs as it has documents; then the documents of a region that are of
    different parts are counted with each other, if their sketches (id, n,
    sketch) are near enough for a link, so unrelated documents that share
    passages make no pairs, and no linked pair is missed.
    """
    # dealt once, for the sizes and for the join with them
    dealt = regions.repartition("region")
    sized = dealt.groupBy("region").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("lead")).where("size > 1")
    rows = saved(dealt.join(sized.withColumnRenamed("region", "__r"), F.col("region") == F.col("__r")).drop("__r"),
                 "regions")
    near = rows.where(F.col("id") != F.col("lead")).groupBy(F.col("id").alias("a"), F.col("lead").alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    led = _chained(near.where((F.col("size") > COUNTED) | (F.col("n") >= SHARED)).select("a", "b"))
    parts = components(led)
    of = measured(parts.select(F.col("id").alias("__id"), F.col("component").alias("__part")))
    told = sketches.select(F.col("id").alias("__of"), "n", "sketch")
    small = saved(rows.where(F.col("size") <= COUNTED).select("region", "id")
                  .join(of, F.col("id") == F.col("__id"), "left").join(told, F.col("id") == F.col("__of"))
                  .select("region", "id", F.coalesce("__part", "id").alias("part"), "n", "sketch"), "parts")
    other = small.select(F.col("region").alias("__r"), F.col("id").alias("b"), F.col("part").alias("__part"),
                         F.col("n").alias("__n"), F.col("sketch").alias("__sketch"))
    counted = (small.join(other, (F.col("region") == F.col("__r")) & (F.col("id") > F.col("b"))
                          & (F.col("part") != F.col("__part")) & _near(percent))
               .groupBy(F.col("id").alias("a"), "b").agg(F.count(F.lit(1)).alias("times"))
               .where(F.col("times") >= SHARED).select("a", "b"))
    whole = parts.where(F.col("id") != F.col("component")).select(F.col("id").alias("a"), F.col("component").alias("b"))
    return saved(whole.union(counted), "shared")


def _arrays(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of a column of sets, and the offsets of the sets."""
    c = column.combine_chunks()
    sizes = np.array(pa.compute.list_value_length(c))
    return c.flatten().to_numpy().view(np.uint64), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


class _Inverted:
    """The sets of a block by shingle, to count common shingles with any set."""

    def __init__(self, flat: np.ndarray, offsets: np.ndarray):
        self.sizes = np.diff(offsets)
        order = np.argsort(flat, kind="stable")
        self.holder = np.repeat(np.arange(len(self.sizes)), self.sizes)[order]
        first = np.concatenate([[True], np.diff(flat[order]) != 0]) if len(flat) else np.zeros(0, bool)
        self.keys = flat[order][first]
        self.cuts = np.append(np.flatnonzero(first), len(flat))

    def common(self, shingles: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, shingles)
        at = at[self.keys[np.minimum(at, len(self.keys) - 1)] == shingles] if len(self.keys) else at[:0]
        if not len(at):
            return np.zeros(len(self.sizes), np.int64)
        held = np.concatenate([self.holder[self.cuts[i]:self.cuts[i + 1]] for i in at])
        return np.bincount(held, minlength=len(self.sizes))


class _Forest:
    def __init__(self):
        self.up: dict = {}

    def root(self, x):
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, a, b) -> bool:
        """Whether a and b were apart until now."""
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def _links(left: pa.Table, right: pa.Table, percent: int) -> list[tuple]:
    """Links between the sets (id, s) of two tables that together join all that are linked."""
    ids, others = left.column("id").to_pylist(), right.column("id").to_pylist()
    flat, offsets = _arrays(left.column("s"))
    index, forest, out = _Inverted(*_arrays(right.column("s"))), _Forest(), []
    for i, name in enumerate(ids):
        own = flat[offsets[i]:offsets[i + 1]]
        common = index.common(own)
        for j in np.flatnonzero(100 * common >= percent * (len(own) + index.sizes - common)):
            if name != others[j] and forest.join(name, others[j]):
                out.append((name, others[j]))
    return out


def _renewed(df: DataFrame) -> DataFrame:
    """The same rows under columns of their own, for a cogroup with a relative."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def _pairs(rows: list[tuple], kind: pa.DataType) -> pa.Table:
    return pa.table({"a": pa.array([r[0] for r in rows], kind), "b": pa.array([r[1] for r in rows], kind)})


def _join_small(members: DataFrame, rows: int, percent: int) -> DataFrame:
    """Links within regions of at most SMALL rows (region, id, s), many regions to a task."""
    def run(key: tuple, t: pa.Table) -> pa.Table:
        t, out = t.sort_by("region"), []
        regions = t.column("region").to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], np.diff(regions) != 0, [True]]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = t.slice(a, b - a)
            out += _links(part, part, percent)
        return _pairs(out, t.schema.field("id").type)

    kind = members.schema["id"].dataType.simpleString()
    return (members.withColumn("bin", F.pmod(F.xxhash64("region"), F.lit(-(-rows // SMALL) or 1)))
            .groupBy("bin").applyInArrow(run, f"a {kind}, b {kind}"))


def _join_blocks(members: DataFrame, percent: int) -> DataFrame:
    """Links within large regions, by blocks of sizes that meet in pairs."""
    step = 1.08
    band = F.floor(F.log(F.size("s").cast("double")) / math.log(step)).cast("int")
    rows = members.withColumn("band", band)
    n = rows.groupBy("region", "band").agg(F.count(F.lit(1)).alias("rows"))
    blocks = saved(n.select("region", "band", F.explode(F.sequence(
        F.lit(0), F.ceil(F.col("rows") / SMALL).cast("int") - 1)).alias("chunk"), "rows"), "blocks")
    reach = math.ceil(math.log(100 / percent) / math.log(step)) + 1
    x = blocks.select("region", F.struct("band", "chunk").alias("x"))
    y = blocks.select(F.col("region").alias("__r"), F.struct("band", "chunk").alias("y"))
    meet = saved(x.join(y, (F.col("region") == F.col("__r")) & (F.col("x") <= F.col("y"))
                        & (F.col("y.band") - F.col("x.band") <= reach)).select("region", "x", "y"), "meetings")
    chunks_of = n.select(F.col("region").alias("__r"), F.col("band").alias("__b"),
                         F.ceil(F.col("rows") / SMALL).alias("chunks"))
    placed = rows.join(chunks_of, (F.col("region") == F.col("__r")) & (F.col("band") == F.col("__b"))).select(
        "region", "id", "s", F.struct("band", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
                                      .alias("chunk")).alias("at"))

    def side(name: str) -> DataFrame:
        m = meet.withColumnRenamed("region", "__r")
        return placed.join(m, (F.col("region") == F.col("__r")) & (F.col("at") == F.col(name))).select(
            "region", F.col("x").alias("x"), F.col("y").alias("y"), "id", "s")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return _pairs(_links(left, right, percent), left.schema.field("id").type)

    kind = members.schema["id"].dataType.simpleString()
    keys = ["region", "x", "y"]
    return side("x").groupBy(*keys).cogroup(_renewed(side("y")).groupBy(*keys)).applyInArrow(run, f"a {kind}, b {kind}")


def _cut(members: DataFrame, sizes: DataFrame, percent: int, depth: int) -> DataFrame:
    """(region, id, child, home): the Voronoi regions of document pivots that each member goes to."""
    place = F.shiftrightunsigned(F.xxhash64(F.lit(depth), "id"), 11) / float(2 ** 53)
    sized = members.join(sizes.withColumnRenamed("region", "__r"), F.col("region") == F.col("__r")).drop("__r")
    chunk_count = F.ceil(F.col("size") / SMALL).cast("int")
    asked = sized.withColumn("chunk", F.pmod(F.xxhash64("id"), chunk_count).cast("int")).select(
        "region", "chunk", "id", "s")
    pivots = (sized.where(place < F.least(2 * chunk_count, F.lit(PIVOTS)) / F.col("size"))
              .withColumn("chunk", F.explode(F.sequence(F.lit(0), chunk_count - 1)))
              .select("region", "chunk", "id", "s"))
    window = 2 * (1 - percent / 100) + 1e-9

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, out = left.column("id").to_pylist(), ([], [], [], [])
        right = right.sort_by("id")
        names = right.column("id").to_pylist() or [None]
        flat, offsets = _arrays(left.column("s"))
        index = _Inverted(*_arrays(right.column("s")))
        for i, name in enumerate(ids):
            own = flat[offsets[i]:offsets[i + 1]]
            common = index.common(own)
            far = 1 - common / (len(own) + index.sizes - common) if right.num_rows else np.zeros(1)
            home = int(far.argmin())
            for j in np.flatnonzero(far <= far[home] + window):
                for column, value in zip(out, (left.column("region")[i].as_py(), name, names[j], j == home)):
                    column.append(value)
        kind = left.schema.field("id").type
        return pa.table({"region": pa.array(out[0], pa.int64()), "id": pa.array(out[1], kind),
                         "pivot": pa.array(out[2], kind), "home": pa.array(out[3], pa.bool_())})

    kind = members.schema["id"].dataType.simpleString()
    got = asked.groupBy("region", "chunk").cogroup(_renewed(pivots).groupBy("region", "chunk")).applyInArrow(
        run, f"region long, id {kind}, pivot {kind}, home boolean")
    return saved(got.withColumn("child", F.xxhash64(F.lit(depth), "region", "pivot")), "voronoi")


def _sized(members: DataFrame) -> DataFrame:
    return members.groupBy("region").agg(F.count(F.lit(1)).alias("size"))


def _join_regions(members: DataFrame, sets: DataFrame, percent: int, depth: int = 0) -> list[DataFrame]:
    """Stored links (a, b) within the regions (region, id)."""
    sizes = saved(_sized(members), "region-sizes")

    def of(some: DataFrame) -> DataFrame:
        """The members (region, id, s) of some regions; the sets join last, and once."""
        chosen = members.join(some.select(F.col("region").alias("__r")), F.col("region") == F.col("__r"), "left_semi")
        return sets.select(F.col("id").alias("__id"), "s").join(
            measured(chosen), F.col("id") == F.col("__id")).select("region", "id", "s")

    small = sizes.where(F.col("size") <= SMALL)
    rows = small.agg(F.sum("size")).first()[0] or 0
    out = [saved(_join_small(of(small), rows, percent), "links")]
    large = sizes.where(F.col("size") > SMALL)
    if large.isEmpty():
        return out
    if depth < DEPTH:
        cut = _cut(of(large), large, percent, depth)
        work = (cut.groupBy("region", "child").agg(F.count(F.lit(1)).alias("n"))
                .groupBy("region").agg(F.sum(F.col("n").cast("double") ** 2).alias("work")))
        better = saved(work.join(large.withColumnRenamed("region", "__r"), (F.col("region") == F.col("__r"))
                                 & (F.col("work") < 0.6 * F.col("size").cast("double") ** 2)).select("region"),
                       "better")
        if not better.isEmpty():
            inner = cut.join(better.withColumnRenamed("region", "__r"), F.col("region") == F.col("__r"),
                             "left_semi").select(F.col("child").alias("region"), "id")
            out += _join_regions(saved(inner, "regions"), sets, percent, depth + 1)
            large = large.join(better.withColumnRenamed("region", "__r"), F.col("region") == F.col("__r"),
                               "left_anti")
    out.append(saved(_join_blocks(of(large), percent), "links"))
    return out


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
         percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    rows, numbered = keyed(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "doc_id")
    texts = rows.select(F.col("__key").alias("id"), "text")
    scan = _scan(texts, words)
    classes = saved(scan.where("n > 0").groupBy("key").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("rows")), "classes")
    copies = measured(
        scan.where("n > 0").select("id", F.col("key").alias("__key"))
        .join(classes.where("rows > 1"), F.col("__key") == F.col("key"))
        .where(F.col("id") != F.col("rep")).select(F.col("id").alias("__id")))
    single = texts.join(copies, F.col("id") == F.col("__id"), "left_anti")
    clusters = components(_shared(_regions(single, words, percent), scan, percent))
    sets = _sets(texts, clusters, words)
    members = clusters.select(F.xxhash64("component").alias("region"), "id")
    links = functools.reduce(DataFrame.union, _join_regions(members, sets, percent))
    labels = components(links).select(F.col("id").alias("__rep"), "component")
    of = classes.select(F.col("key").alias("__key"), "rep").join(
        measured(labels), F.col("rep") == F.col("__rep"), "left").select(
        "__key", F.coalesce("component", "rep").alias("component"))
    out = scan.select("id", "n", "key").join(of, (F.col("key") == F.col("__key")) & (F.col("n") > 0), "left")
    out = out.select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    if not numbered:
        return out.withColumnRenamed("id", "doc_id")
    # numbers follow the ids, so a component's smallest number is a row of its smallest id
    ids = rows.select(F.col("__key").alias("__k"), "doc_id")
    named = out.join(ids, F.col("id") == F.col("__k")).select("doc_id", "n_shingles", "component_id")
    first = ids.select(F.col("__k"), F.col("doc_id").alias("__first"))
    return named.join(first, F.col("component_id") == F.col("__k")).select(
        "doc_id", "n_shingles", F.col("__first").alias("component_id"))

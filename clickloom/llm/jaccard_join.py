"""N-gram Jaccard join by grouped prefixes, and the components of its links.

A document's set has the hashes of its distinct word n-grams.  Two sets link if ``100 * intersection >= percent *
union``.  Sets are ordered by (frequent or not, hash); two sets that link share an element of their prefixes.

1. Documents with one set collapse to a class.  Classes with one size and one prefix collapse to a group.
2. Groups that share a prefix element are candidates.  Group pairs are filtered by size, by the places of the shared
   element, and by parity bitmaps: their Hamming distance is a lower bound of the symmetric difference.
3. Surviving pairs are expanded to their members and verified with the whole sets.

Only components are asked for, so pairs inside a component that is known need no verification.  A star round comes
first: every group is compared with one centre per shared element, the group in which the element comes first, because
few rare elements stand before it; and every member with its group's centre.  The last round takes every candidate
pair between different components.  It drops none, so no link between components is lost, while a large group of near
copies costs about as many pairs as it has members and elements, not the square of its size.

Frequent elements only affect the order, and any set of them gives right results.  They are found by counts per slice
and then by counting all prefixes made with these, and sent as a bitmap of fixed size; an element that shares its bit
with a frequent one counts as frequent too.  The sets themselves are made from the texts again where they are needed:
a bitmap of fixed size marks the documents in question, and only their sets are shuffled.

Defined results: without words the set is empty and linked with nothing; fewer words than n are one element; copies
of any number are one class; repeated rows and rows with one doc_id get what their text says; a null doc_id is never
the smallest of a component unless there is no other.  64-bit hashes stand for n-grams, 128 bits for sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.batches import cuts, map_texts
from clickloom.session import Scratch

WIDTH = 4
PERCENT = 85
# Bits of the bitmap of frequent elements, which are put behind the others in the order of elements.
FREQUENT_BITS = 1 << 26
# An element is counted first where it stands in so many sets of one slice; it is frequent from this sum on.
SEEN_IN_SLICE = 3
FREQUENT_FROM = 8
SLICE = 24 << 20
# Bits of the bitmap of documents whose sets are wanted.
WANTED_BITS = 1 << 23

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_CODE = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    return x ^ (x >> np.uint64(29))


def _powers(n: int) -> np.ndarray:
    base = np.full(n + 1, _A, np.uint64)
    base[0] = 1
    return np.cumprod(base)


def word_hashes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and the number of words of each text."""
    raw = b" ".join(t or b"" for t in texts) + b" "
    data = _LOWER[np.frombuffer(raw, np.uint8)]
    inside = _WORD[data]
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    bounds = np.cumsum([len(t or b"") + 1 for t in texts])
    n_words = np.diff(np.searchsorted(starts, bounds), prepend=0)
    if not len(starts):
        return np.zeros(0, np.uint64), n_words
    size = ends - starts
    power = _powers(int(size.max()))
    flat = np.flatnonzero(inside)
    first = np.cumsum(size) - size
    place = np.arange(len(flat)) - np.repeat(first, size)
    hashes = np.add.reduceat(_CODE[data[flat]] * power[place], first)
    return _mix(hashes + size.astype(np.uint64) * _B), n_words


def element_sets(texts: list, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    sizes = np.array([len(t or b"") for t in texts], np.int64)
    for a, b in cuts(sizes, 1 << 20):
        words, n_words = word_hashes(texts[a:b])
        sums = np.zeros(len(words), np.uint64)
        for k in range(width if len(words) >= width else 0):
            sums[:len(words) - k] = sums[:len(words) - k] * _A + words[k:]
        sums = _mix(sums).view(np.int64)
        start = 0
        for n in n_words:
            if n >= width:
                made = np.sort(sums[start:start + n - width + 1])
                yield made[np.concatenate(([True], made[1:] != made[:-1]))]
            elif n:
                short = words[start:start + n].tobytes()
                yield np.array([xxhash.xxh3_64_intdigest(short, int(n))], np.uint64).view(np.int64)
            else:
                yield np.zeros(0, np.int64)
            start += n


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1 if n else 0


def ordered(elements: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The elements in the common order: those whose bit is set in ``frequent`` last."""
    bit = elements & (FREQUENT_BITS - 1)
    often = (frequent[bit >> 6] >> (bit & 63)) & 1 == 1
    return np.concatenate((elements[~often], elements[often]))


def parity_bitmap(elements: np.ndarray) -> np.ndarray:
    """A bit per residue of the elements, set if their number is odd; 2 to 4 bits per element, 64 at least."""
    bits = 64
    while bits < 2 * len(elements):
        bits *= 2
    odd = np.bincount(elements & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)])))


def _bits(rows: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of the residues of column ``h``: as many 64-bit words as ``bits`` needs come to the driver at most."""
    bit = F.col("h").bitwiseAND(bits - 1)
    words = rows.select(F.shiftright(bit, 6).alias("w"), (bit % 64).cast("int").alias("b")).groupBy("w").agg(
        F.bit_or(F.expr("shiftleft(1L, b)")).alias("v")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words.column("w").to_numpy()] = words.column("v").to_numpy()
    return out


def frequent_elements(docs: DataFrame, text: str, width: int, percent: int) -> np.ndarray:
    """A bitmap of the elements that stand in many different sets.

    First those that are frequent within slices; then those that are frequent in the prefixes that these give.
    """
    def counted(frequent) -> DataFrame:
        def compute(texts: list) -> list:
            seen: dict[bytes, np.ndarray] = {}
            for s in element_sets(texts, width):
                if len(s) > 1:
                    some = s if frequent is None else ordered(s, frequent.value)[:prefix_length(len(s), percent)]
                    seen[xxhash.xxh3_128_digest(s.tobytes())] = some
            every = np.sort(np.concatenate([*seen.values(), np.zeros(0, np.int64)]))
            new = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1]))) if len(every) else every
            n = np.diff(np.append(new, len(every)))
            found = n >= (SEEN_IN_SLICE if frequent is None else 1)
            # all of a slice on its first row
            ends = np.concatenate(([0], np.full(len(texts), found.sum()))).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(ends), pa.array(x[found])) for x in (every[new], n)]

        made = map_texts(docs, text, [], compute, "e array<long>, n array<long>", SLICE)
        sums = made.select(F.inline(F.arrays_zip("e", "n"))).groupBy("e").agg(F.sum("n").alias("n"))
        return sums.where(F.col("n") >= FREQUENT_FROM).select(F.col("e").alias("h"))

    first = _bits(counted(None), FREQUENT_BITS)
    return first | _bits(counted(docs.sparkSession.sparkContext.broadcast(first)), FREQUENT_BITS)


def signatures(docs: DataFrame, key: str, text: str, width: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """``doc, n, d1, d2`` (size and digest of the set), ``prefix`` and ``bitmap`` for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def compute(texts: list) -> list:
        n, digest, prefixes, bitmaps = [], [], [], []
        for s in element_sets(texts, width):
            n.append(len(s))
            digest.append(xxhash.xxh3_128_digest(s.tobytes()))
            prefixes.append(ordered(s, sent.value)[:prefix_length(len(s), percent)])
            bitmaps.append(parity_bitmap(s))
        both = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
        return [np.array(n, np.int64), both[:, 0].copy(), both[:, 1].copy(), _lists(prefixes), _lists(bitmaps)]

    return map_texts(docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").alias("text")), "text", ["doc"],
                     compute, "n long, d1 long, d2 long, prefix array<long>, bitmap array<long>")


def sets_of(docs: DataFrame, wanted: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``k, elements`` for the classes in ``wanted`` (k, rep, d1, d2), made from the texts of their documents."""
    sent = docs.sparkSession.sparkContext.broadcast(
        _bits(wanted.select(F.xxhash64("rep").alias("h")), WANTED_BITS))
    rows = docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    rows = rows.select("text", "doc", F.xxhash64("doc").bitwiseAND(WANTED_BITS - 1).alias("h"))
    kind = rows.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(2).to_numpy()
            hit = pa.array((sent.value[h >> 6] >> (h & 63)) & 1 == 1)
            batch = batch.filter(hit)
            sizes = np.array([len(t.as_py() or b"") for t in batch.column(0)], np.int64)
            for a, b in cuts(sizes, 4 << 20):
                sets = list(element_sets(batch.column(0).slice(a, b - a).to_pylist(), width))
                digest = b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets)
                both = np.frombuffer(digest, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(a, b - a), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()),
                     _lists(sets)], names=["doc", "d1", "d2", "elements"])

    made = rows.mapInArrow(run, f"doc {kind}, d1 long, d2 long, elements array<long>")
    # a doc_id may stand on several rows: one of them has the wanted set, any one if it is repeated
    found = made.join(wanted.select("k", "rep", "d1", "d2"), ["d1", "d2"]).where(F.col("doc").eqNullSafe(F.col("rep")))
    return found.groupBy("k").agg(F.first("elements").alias("elements"))


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``k, label``: for every node of the links the smallest node that it can reach.

    Minimum labels travel along the links and then jump to the label of the label, until nothing changes; a step is
    a join and a minimum, and its result is written, so no node's links are ever collected.
    """
    both = scratch.keep(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                        .distinct())
    labels = scratch.keep(both.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m")).select(
        "k", F.least("k", "m").alias("label")))
    while True:
        heard = both.join(labels.withColumnRenamed("k", "b"), "b").groupBy(F.col("a").alias("k")).agg(
            F.min("label").alias("m"))
        near = labels.join(heard, "k").select("k", F.col("label").alias("old"), F.least("label", "m").alias("near"))
        target = labels.select(F.col("k").alias("near"), F.col("label").alias("far"))
        stepped = scratch.keep(near.join(target, "near").select("k", "old", F.least("near", "far").alias("label")))
        changed = stepped.where("old <> label").limit(1).count()
        labels = stepped.select("k", "label")
        if not changed:
            return labels


def _needed(percent: int, a: Column, b: Column) -> Column:
    """The intersection that two sets of these sizes need."""
    return F.ceil((a + b) * percent / F.lit(float(100 + percent)) - 1e-9)


def _close(a: Column, b: Column, percent: int) -> Column:
    """Sizes that allow a link."""
    return (100 * F.least(a, b)) >= percent * F.greatest(a, b)


def _bitmaps_allow(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (na, nb, ma, mb) whose bitmaps do not prove that the sets differ in too many elements."""
    size = F.least(F.size("ma"), F.size("mb"))

    def folded(name: str) -> Column:
        # sizes of linked sets differ by less than two, their bitmaps by one halving at most
        m = F.col(name)
        half = F.transform(F.sequence(F.lit(0), size - 1), lambda i: m[i].bitwiseXOR(m[i + size]))
        return F.when(F.size(m) == size, m).otherwise(half)

    distance = F.aggregate(F.zip_with(folded("ma"), folded("mb"), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                           F.lit(0), lambda s, x: s + x)
    most = F.col("na") + F.col("nb") - 2 * _needed(percent, F.col("na"), F.col("nb"))
    return pairs.where((F.greatest(F.size("ma"), F.size("mb")) <= 2 * size) & (distance <= most))


class _Join:
    """The state of one join: classes, groups, prefix elements and the labels found so far."""

    def __init__(self, docs: DataFrame, key: str, text: str, width: int, percent: int):
        self.docs, self.key, self.text, self.width, self.percent = docs, key, text, width, percent
        self.scratch = scratch = Scratch(docs.sparkSession)
        self.signed = scratch.keep(signatures(docs, key, text, width, percent,
                                              frequent_elements(docs, text, width, percent)))
        full = self.signed.where("n > 0")
        self.classes = scratch.keep(full.groupBy("n", "d1", "d2").agg(
            F.min("doc").alias("rep"), F.first("prefix").alias("prefix"), F.first("bitmap").alias("bitmap")
        ).withColumn("k", F.monotonically_increasing_id()))
        grouped = self.classes.groupBy("n", "prefix").agg(F.min("k").alias("g"), F.count("*").alias("members"))
        self.groups = scratch.keep(grouped)
        self.members = scratch.keep(self.classes.select("k", "n", "prefix").join(self.groups, ["n", "prefix"])
                                    .select("k", "g", "n", "members"))
        places = self.groups.select("g", "n", F.posexplode("prefix").alias("i", "e"))
        shared = places.groupBy("e").agg(F.count("*").alias("c")).where("c > 1").drop("c")
        self.places = scratch.keep(places.join(shared, "e"))
        self.links: DataFrame | None = None
        self.labels: DataFrame | None = None

    def labelled(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` with the component of the class in column ``name``: its label or, unlinked, itself."""
        out = f"l_{name}"
        if self.labels is None:
            return rows.withColumn(out, F.col(name))
        known = self.labels.select(F.col("k").alias(name), F.col("label").alias("_l"))
        return rows.join(known, name, "left").withColumn(out, F.coalesce("_l", name)).drop("_l")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs of classes (a, b) that link, after the bitmaps and with the whole sets."""
        facts = self.classes.select("k", "n", "bitmap")
        side = lambda x: facts.select(F.col("k").alias(x), F.col("n").alias(f"n{x}"), F.col("bitmap").alias(f"m{x}"))
        near = pairs.select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b")
        near = self.scratch.keep(_bitmaps_allow(near, self.percent).select("a", "b", "na", "nb"))
        ids = near.select(F.col("a").alias("k")).unionByName(near.select(F.col("b").alias("k"))).distinct()
        wanted = self.scratch.keep(self.classes.select("k", "rep", "d1", "d2").join(ids, "k"))
        sets = self.scratch.keep(sets_of(self.docs, wanted, self.key, self.text, self.width))
        with_a = near.join(sets.select(F.col("k").alias("a"), F.col("elements").alias("ea")), "a")
        with_b = with_a.join(sets.select(F.col("k").alias("b"), F.col("elements").alias("eb")), "b")
        common = F.size(F.array_intersect("ea", "eb"))
        return self.scratch.keep(with_b.where(
            (100 + self.percent) * common >= self.percent * (F.col("na") + F.col("nb"))).select("a", "b"))

    def add(self, pairs: DataFrame) -> None:
        found = self.verified(pairs)
        self.links = found if self.links is None else self.links.unionByName(found)
        self.labels = components(self.links, self.scratch)

    def possible(self, na: str, ia: str, nb: str, ib: str) -> Column:
        """Whether two groups can link if this shared element is the first one that they share: the sizes are close,
        and each has enough elements from here on."""
        rest = F.least(F.col(na) - F.col(ia), F.col(nb) - F.col(ib))
        return _close(F.col(na), F.col(nb), self.percent) & (rest >= _needed(self.percent, F.col(na), F.col(nb)))

    def star_round(self) -> None:
        """Compare every group with one centre per shared element, and every member with one of its group."""
        chance = F.xxhash64("e", "g")
        centre = self.places.groupBy("e").agg(F.min(F.struct(
            "i", chance.alias("h"), F.col("g").alias("c"), F.col("n").alias("nc"))).alias("m"))
        pairs = self.places.join(centre.select("e", "m.c", "m.nc", F.col("m.i").alias("ic")), "e").where(
            (F.col("g") != F.col("c")) & self.possible("n", "i", "nc", "ic"))
        pairs = pairs.select(F.least("g", "c").alias("a"), F.greatest("g", "c").alias("b"))
        chance = F.xxhash64("k")
        mates = self.members.where("members > 1")
        one = mates.groupBy("g").agg(F.min(F.struct(chance.alias("h"), F.col("k").alias("c"))).alias("m"))
        # an expanded group: each member with the group's first one, which stands for it above, and with another
        inner = mates.join(one.select("g", "m.c"), "g").select("k", F.explode(F.array("g", "c")).alias("c")).where("k <> c")
        inner = inner.select(F.least("k", "c").alias("a"), F.greatest("k", "c").alias("b"))
        both = self.labelled(self.labelled(pairs.unionByName(inner).distinct(), "a"), "b")
        self.add(both.where("l_a <> l_b"))

    def last_round(self) -> None:
        """Every candidate pair between different components."""
        labelled = self.scratch.keep(self.labelled(self.members, "k"))
        # a group whose members lie in several components has no component of its own
        pure = labelled.groupBy("g").agg(F.min("l_k").alias("low"), F.max("l_k").alias("high")).select(
            "g", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(-1 - F.col("g")).alias("comp"))
        places = self.scratch.keep(self.places.join(pure, "g"))
        sizes = places.groupBy("e", "comp").agg(F.count("*").alias("c"))
        main = sizes.groupBy("e").agg(F.max(F.struct("c", "comp")).alias("m"), F.count("*").alias("comps")).where(
            "comps > 1").select("e", F.col("m.comp").alias("main"))
        rows = self.scratch.keep(places.join(main, "e"))
        # the largest component of an element meets only the others; these are the left side
        left = rows.where("comp <> main or comp < 0").select("e", F.col("g").alias("ga"), F.col("n").alias("na"),
                                                             F.col("i").alias("ia"), F.col("comp").alias("ca"))
        right = rows.select("e", F.col("g").alias("gb"), F.col("n").alias("nb"), F.col("i").alias("ib"),
                            F.col("comp").alias("cb"))
        met = left.join(right, "e").where((F.col("ca") != F.col("cb")) & self.possible("na", "ia", "nb", "ib"))
        groups = met.select(F.least("ga", "gb").alias("ga"), F.greatest("ga", "gb").alias("gb")).distinct()
        mixed = pure.where("comp < 0").select(F.col("g").alias("ga"), F.col("g").alias("gb"))
        member = lambda x: labelled.select(F.col("g").alias(f"g{x}"), F.col("k").alias(x), F.col("l_k").alias(f"l_{x}"))
        pairs = groups.unionByName(mixed).join(member("a"), "ga").join(member("b"), "gb").where(
            "l_a <> l_b and (ga <> gb or a < b)")
        self.add(pairs.select("a", "b"))


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
                       percent: int = PERCENT) -> DataFrame:
    """The key, ``n_shingles``, ``component_id`` (smallest key that links reach) and ``n_links`` of every row.

    ``n_links`` counts the verified links of the row's class to other classes, not those that a known component
    made unnecessary.
    """
    join = _Join(docs, key, text, width, percent)
    join.star_round()
    join.last_round()
    scratch = join.scratch
    named = join.labelled(join.classes.select("k", "rep", "d1", "d2"), "k")
    least = named.groupBy("l_k").agg(F.min("rep").alias("component"))
    ends = join.links.select(F.explode(F.array("a", "b")).alias("k")).groupBy("k").agg(F.count("*").alias("links"))
    result = scratch.keep(named.join(least, "l_k").join(ends, "k", "left").select(
        "d1", "d2", "component", F.coalesce("links", F.lit(0).cast("long")).alias("links")))
    return join.signed.select("doc", "n", "d1", "d2").join(result, ["d1", "d2"], "left").select(
        F.col("doc").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc")).alias("component_id"),
        F.coalesce("links", F.lit(0).cast("long")).alias("n_links"))


def keep_one_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows whose key is the smallest of their component, all columns as they were."""
    cols = docs.columns
    names = [f"_c{i}" for i in range(len(cols))]
    rows = docs.toDF(*names)
    k, x = names[cols.index(key)], names[cols.index(text)]
    found = jaccard_components(rows, k, x, **options)
    first = found.where(F.col(k).eqNullSafe(F.col("component_id"))).select(F.col(k).alias("_first")).distinct()
    return rows.join(first, F.col(k).eqNullSafe(F.col("_first")), "left_semi").toDF(*cols)

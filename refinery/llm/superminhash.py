"""Near-duplicate documents by SuperMinHash signatures, banding, verification and components.

A SuperMinHash signature gives each element a random permutation of the m slots; slot p[j] takes
the least of ``j + r`` over all elements, ``r`` uniform in [0, 1). The ranks of one element are
spread over all slots, so estimates vary less than with independent hashes. The levels j are run
for all elements of a block at once, and a document stops as soon as all its slots are filled by
the levels done: what follows can only be larger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from refinery.llm.components import components
from refinery.llm.stored import stored
from refinery.llm.textbatch import blocks, mix, salted, shingle_sets

SLOTS, BANDS = 128, 32
ROWS = SLOTS // BANDS
#: Two texts with a similarity of 0.8 differ in about 13 of 128 signature bits, standard deviation
#: 3.4; a pair with more differing bits than this is not verified.
MOST_BITS = 36

#: Elements whose permutations are held at a time.
AT_A_TIME = 1 << 17

_SIGNED = "doc_id bigint, n_shingles bigint, high bigint, low bigint, bits array<bigint>, bands array<bigint>"


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """One row of ``slots`` values per set: level in the upper 32 bits, r in the lower ones.

    Rows of empty sets hold the largest value everywhere.
    """
    out = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    flat = out.reshape(-1)
    sizes = np.array([len(s) for s in sets], np.int64)
    if not sizes.sum():
        return out
    all_elements, all_owners = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    for first in range(0, len(all_elements), AT_A_TIME):
        _fill(out, flat, all_elements[first : first + AT_A_TIME], all_owners[first : first + AT_A_TIME])
    return out


def _fill(out: np.ndarray, flat: np.ndarray, elements: np.ndarray, owners: np.ndarray) -> None:
    """Lower the slots of ``out`` by these elements, level by level."""
    slots = out.shape[1]
    order = np.empty((len(elements), slots), np.uint8 if slots <= 256 else np.uint16)
    order[:] = np.arange(slots)
    with np.errstate(over="ignore"):
        for level in range(slots):
            draw = salted(elements, level)
            pick = level + (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(slots - level)) >> np.uint64(32)).astype(np.int64)
            lines = np.arange(len(elements))
            slot = order[lines, pick].astype(np.int64)
            order[lines, pick] = order[:, level]
            value = (np.uint64(level) << np.uint64(32)) | (draw >> np.uint64(32))
            np.minimum.at(flat, owners * slots + slot, value)
            unfilled = (out >> np.uint64(32) > np.uint64(level)).any(axis=1)
            going = unfilled[owners]
            if not going.any():
                break
            if not going.all():
                elements, owners, order = elements[going], owners[going], order[going]


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    rows = signature.shape[1] // bands
    weights = mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
    with np.errstate(over="ignore"):
        parts = (mix(signature).reshape(len(signature), bands, rows) * weights).sum(axis=2, dtype=np.uint64)
        return mix(parts + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def signature_bits(signature: np.ndarray) -> np.ndarray:
    """One bit per slot, packed into 64-bit integers."""
    bits = (mix(signature) >> np.uint64(17)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8), axis=1).view(np.int64)


def _fingerprint(values: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        high = mix(mix(values) + np.uint64(1)).sum(dtype=np.uint64)
        low = mix(mix(values ^ np.uint64(0x5851F42D4C957F2D)) + np.uint64(2)).sum(dtype=np.uint64)
    return int(high.view(np.int64)), int(low.view(np.int64))


def _fixed_lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(values.view(np.int64).reshape(-1)))


def _signed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for row, data, offsets in blocks(batch.column("text")):
                sets = shingle_sets(data, offsets, size)
                signature = signatures(sets)
                prints = np.array([_fingerprint(s) for s in sets], np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(row, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(prints[:, 0].copy()),
                        pa.array(prints[:, 1].copy()),
                        _fixed_lists(signature_bits(signature)),
                        _fixed_lists(band_keys(signature)),
                    ],
                    ["doc_id", "n_shingles", "high", "low", "bits", "bands"],
                )

    return run


def _set_bytes(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for row, data, offsets in blocks(batch.column("text")):
                sets = shingle_sets(data, offsets, size)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, len(sets)), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["doc_id", "shingles"],
                )

    return run


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = np.zeros(batch.num_rows, bool)
            left, right = batch.column("left"), batch.column("right")
            for i in range(batch.num_rows):
                a = np.frombuffer(left[i].as_buffer(), np.uint64)
                b = np.frombuffer(right[i].as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                linked[i] = 100 * both >= percent * (len(a) + len(b) - both)
            yield batch.select(["a", "b"]).filter(pa.array(linked))

    return run


def difference_prefix(leader: np.ndarray, other: np.ndarray, percent: int) -> tuple[bool, np.ndarray, int, int]:
    """Whether two sets are linked; the part of their difference that partners must meet; how much of
    it is the short part; and the size of the whole difference.

    Let B be the leader's set and D(X) what X and B do not share. X and Y differ in
    |D(X)| + |D(Y)| - 2 |D(X) & D(Y)| elements and are linked if that is at most c (|X| + |Y|),
    c = (100 - percent) / (100 + percent). If X is not linked to B, |D(X)| > c (|X| + |B|), and a
    link to any Y needs common elements: more than (|D| - c |X| + c |B|) / 2 of X's if Y is not
    linked to B either, or of Y's if it is, and at least (|D| - c |X| - c |B|) / 2 of X's then. With
    n needed, two sets in the same order must share one of the first |D| - n + 1 of each.
    The order puts elements outside B first, since copies seldom share their own changes.
    """
    added = np.setdiff1d(other, leader, assume_unique=True)
    removed = np.setdiff1d(leader, other, assume_unique=True)
    size, both = len(added) + len(removed), len(leader) - len(removed)
    linked = 100 * both >= percent * (len(leader) + len(added))
    up, down = 100 + percent, 100 - percent
    short = size - (up * size - down * len(other) + down * len(leader)) // (2 * up)
    most = short
    if not linked:
        needed = -(-(up * size - down * (len(other) + len(leader))) // (2 * up))
        most = size - max(needed, 1) + 1
    difference = np.concatenate((added, removed))
    return linked, difference[: max(most, 0)], max(min(short, size), 0), size


_STAR = "a bigint, b bigint, linked boolean, difference array<bigint>, short int, size int, n int"


def _differences(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left"), batch.column("right")
            linked, parts, short, size, n = [], [], [], [], []
            for i in range(batch.num_rows):
                other = np.frombuffer(right[i].as_buffer(), np.uint64)
                found = difference_prefix(np.frombuffer(left[i].as_buffer(), np.uint64), other, percent)
                linked.append(found[0])
                parts.append(found[1].view(np.int64))
                short.append(found[2])
                size.append(found[3])
                n.append(len(other))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("a"),
                    batch.column("b"),
                    pa.array(linked, pa.bool_()),
                    pa.array(parts, pa.list_(pa.int64())),
                    *[pa.array(values, pa.int32()) for values in (short, size, n)],
                ],
                ["a", "b", "linked", "difference", "short", "size", "n"],
            )

    return run


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int, name: str) -> DataFrame:
    """Those of the pairs (a, b) whose full shingle sets are similar enough."""
    return stored(_with_sets(pairs, sets).mapInArrow(_similar(percent), "a bigint, b bigint"), name)


def near_duplicates(
    documents: DataFrame, *, shingle: int = 5, percent: int = 80
) -> DataFrame:
    """Per row of ``documents``: doc_id, n_shingles, component_id, kept.

    Texts are lower-cased (A-Z), cut into words ``[^\\x20\\x09-\\x0D]+`` and taken as the set of
    distinct ``shingle``-word shingles; two are linked if 100 * intersection >= ``percent`` *
    union. A shorter text is one shingle. A text without words, or null, links with nothing.

    1. Rows with equal sets form a class, and its least doc_id stands for it.
    2. Signatures of 128 slots in 32 bands of 4: a pair at 0.8 shares no band with a
       probability of 5e-8. Each bucket is led by the member that meets most others in all its
       buckets, which in a group of copies is the text next to what they have in common. All
       others are compared with the leader.
    3. Members outside the component of their bucket's leader choose a leader among themselves.
    4. What is left are members X that are not linked to the leader. A link from X to another
       member needs common elements in what each of them does not share with the leader, see
       :func:`difference_prefix`; a join on these finds every such pair, without making all
       pairs of a group. Pairs in one component, or whose sizes or signature bits rule a link
       out, are not verified.
    5. Links are confirmed on full sets; components come from distributed star rounds.

    Rows with a null doc_id form no links: component_id is null and kept false. Repeated rows
    share a component. Columns other than doc_id and text are ignored. An empty table gives an
    empty result.
    """
    documents = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    signed = stored(documents.mapInArrow(_signed(shingle), _SIGNED), "signed")
    usable = signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = usable.groupBy("high", "low").agg(
        F.min("doc_id").alias("rep"), F.min_by(F.struct("n_shingles", "bits", "bands"), "doc_id").alias("of")
    )
    classes = stored(classes.select("high", "low", "rep", "of.*"), "classes")
    one_each = classes.select("rep", "n_shingles", "bits", "bands")

    buckets = one_each.select("rep", F.explode("bands").alias("band"))
    sizes = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = stored(buckets.join(sizes, "band"), "members")
    crowds = stored(members.groupBy("rep").agg(F.sum("members").alias("crowd")), "crowds")
    about = stored(crowds.join(one_each.select("rep", "n_shingles", "bits"), "rep"), "about")
    texts = documents.join(crowds.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    sets = stored(texts.mapInArrow(_set_bytes(shingle), "doc_id bigint, shingles binary"), "sets")

    members = stored(members.select("band", "rep").join(crowds, "rep"), "bucket-members")
    star = _leader_pairs(members)
    compared = stored(_with_sets(star, sets).mapInArrow(_differences(percent), _STAR), "compared")
    links = compared.filter("linked").select("a", "b")

    second = _plausible(_leader_pairs(_outside_leader(members, links)), about, percent)
    links = links.union(_linked(second, sets, percent, "second-links"))
    found = stored(components(links), "components")

    rest = _plausible(_meeting_pairs(compared, found, percent), about, percent)
    final = _merged(found, _linked(rest, sets, percent, "rest-links"))

    by_rep = classes.join(final.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "high", "low", F.coalesce("component", "rep").alias("component_id")
    )
    usable_ids = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    out = signed.select("doc_id", "n_shingles", "high", "low", usable_ids.alias("usable"))
    out = out.join(by_rep.withColumn("usable", F.lit(True)), ["high", "low", "usable"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )


def _leader_pairs(members: DataFrame) -> DataFrame:
    """Distinct pairs (a: a bucket's leader, b: another member)."""
    order = F.struct("crowd", (-F.col("rep")).alias("last"))
    leaders = members.groupBy("band").agg(F.max(order).alias("lead"))
    leaders = leaders.select("band", (-F.col("lead.last")).alias("a"))
    return members.join(leaders, "band").filter("rep <> a").select("a", F.col("rep").alias("b")).distinct()


def _outside_leader(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members that are not linked to their bucket's leader."""
    order = F.struct("crowd", (-F.col("rep")).alias("last"))
    leads = members.groupBy("band").agg((-F.max(order)["last"]).alias("a"))
    with_lead = members.join(leads, "band").filter("rep <> a").withColumnRenamed("rep", "b")
    return with_lead.join(links, ["a", "b"], "left_anti").select("band", F.col("b").alias("rep"), "crowd")


def _placed(pairs: DataFrame, found: DataFrame, node: str, name: str) -> DataFrame:
    place = found.select(F.col("node").alias(node), F.col("component").alias(name))
    return pairs.join(place, node, "left").withColumn(name, F.coalesce(name, node))


def _merged(found: DataFrame, more: DataFrame) -> DataFrame:
    """Components after further links: those links join whole components."""
    if more.isEmpty():
        return found
    between = _placed(_placed(more, found, "a", "_ca"), found, "b", "_cb").select("_ca", "_cb").distinct()
    joined = stored(components(between), "joined-components")
    # Nodes that had no link before are components of their own.
    nodes = found.union(joined.select("node", F.col("node").alias("component"))).distinct()
    moved = joined.select(F.col("node").alias("component"), F.col("component").alias("to"))
    return stored(
        nodes.join(moved, "component", "left").groupBy("node").agg(F.min(F.coalesce("to", "component")).alias("component")),
        "merged-components",
    )


def _plausible(pairs: DataFrame, about: DataFrame, percent: int) -> DataFrame:
    """Pairs that neither sizes nor signature bits rule out."""
    for side in ("a", "b"):
        pairs = pairs.join(
            about.select(F.col("rep").alias(side), F.col("n_shingles").alias(f"_n{side}"), F.col("bits").alias(f"_bits{side}")),
            side,
        )
    differing = F.lit(0)
    for i in range(SLOTS // 64):
        differing = differing + F.bit_count(F.col("_bitsa")[i].bitwiseXOR(F.col("_bitsb")[i]))
    sizes = 100 * F.least("_na", "_nb") >= percent * F.greatest("_na", "_nb")
    return pairs.filter(sizes & (differing <= MOST_BITS)).select("a", "b")


def _meeting_pairs(compared: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Pairs of one leader's members in different components that meet in their differences.

    Where a pair meets first, what follows in both differences has to hold all the common elements it
    needs; a pair that meets too late for that is left out.
    """
    lead = compared.withColumnsRenamed({"a": "lead", "b": "x"})
    open_leads = lead.filter("NOT linked").select("lead").distinct()
    placed = _placed(lead.join(open_leads, "lead", "left_semi"), found, "x", "component")
    parts = placed.select("lead", "x", "linked", "component", "short", "size", "n", F.posexplode("difference").alias("at", "element"))
    rest = (F.col("size") - F.col("at")).alias("rest")
    parts = parts.select("lead", "x", "linked", "component", "size", "n", rest, F.expr("at < short").alias("short"), "element")
    parts = stored(parts, "differences")
    one = parts.filter("NOT linked").alias("p")
    two = parts.filter("short").alias("q")
    up, down = 100 + percent, 100 - percent
    needed = up * (F.col("p.size") + F.col("q.size")) - down * (F.col("p.n") + F.col("q.n"))
    meet = (
        (F.col("p.lead") == F.col("q.lead"))
        & (F.col("p.element") == F.col("q.element"))
        & (F.col("p.component") != F.col("q.component"))
        & (F.col("q.linked") | (F.col("p.short") & (F.col("p.x") < F.col("q.x"))))
        & (2 * up * F.least("p.rest", "q.rest") >= needed)
        & (100 * F.least("p.n", "q.n") >= percent * F.greatest("p.n", "q.n"))
    )
    pairs = one.join(two, meet).select(F.least("p.x", "q.x").alias("a"), F.greatest("p.x", "q.x").alias("b"))
    return pairs.distinct()

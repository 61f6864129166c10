"""SimHash near-duplicates by generalised pigeonhole.

A fingerprint has bit i set if more than half of a text's shingle hashes have it. Texts
whose fingerprints differ in at most `distance` bits are linked, and links join into
components.

The 64 bits are grouped into parts, correlated bits together, so that parts are as
independent of each other as the data allow. Part p gets its own threshold t_p; the
thresholds add up to distance - parts + 1 (a part with threshold -1 is not looked at).
By the generalised pigeonhole principle two fingerprints within the distance differ by at
most t_p in at least one part p. Layout and thresholds are chosen by dynamic programming
on candidate counts estimated from a bounded sample; they decide the cost, never the
result. Each fingerprint is filed under its value in every part, and probes with the
values within t_p of it. Fingerprints that meet are verified on all 64 bits.

Hot values: equal fingerprints are one row from the start. A part value that more than
`split` rows share is filed anew under that value and a second pigeonhole over the bits
parted otherwise, three times at most. What is hot even then is compared block against
block, each two blocks as a group of about `split` rows. Within a group only a spanning
set of links is written, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from jobtide.llm.components import components
from jobtide.llm.frames import by_place, pick, place, stored, utf8

BITS = 64
ONE = np.uint64(1)


@dataclass(frozen=True)
class Settings:
    """Parameters of fingerprints and search."""

    shingle: int = 4
    seed: int = 42
    distance: int = 4
    sample: int = 8_000  # fingerprints that the layout is estimated on, at most
    split: int = 4_000  # rows of one part value that one task compares


def fingerprint(text: str | None, shingle: int, seed: int) -> int:
    """The 64-bit fingerprint of a text; 0 without words.

    A-Z are lower-cased. Shingles are runs of `shingle` words joined by a space, repeats
    included; a text with fewer words is one shingle.
    """
    words = utf8(text).lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist())]
    packed = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
    # Rows of 64 bits, least significant first.
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(packed), 1 << 16):
        counts += np.unpackbits(packed[at : at + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > len(hashes)).tolist())


def fingerprints(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, fingerprint as a signed long) of every whole text; null and empty texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [
                fingerprint(t, settings.shingle, settings.seed) for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(values, np.uint64).view(np.int64))],
                ["doc_id", "fingerprint"],
            )

    return pick(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, fingerprint long")


def bit_rows(values: np.ndarray) -> np.ndarray:
    """0/1 rows of fingerprints, least significant bit first."""
    return np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def group_bits(rows: np.ndarray, bits: list[int], parts: int) -> list[list[int]]:
    """Bits in `parts` groups of nearly equal size, correlated bits together.

    Each group starts with the free bit of the strongest correlation to another free one
    and takes the free bit most correlated to the group until it is full.
    """
    if len(rows) > 1:
        centred = rows[:, bits] - rows[:, bits].mean(axis=0)
        spread = np.sqrt((centred**2).sum(axis=0))
        spread[spread == 0] = np.inf
        bond = np.abs(centred.T @ centred) / np.outer(spread, spread)
    else:
        bond = np.zeros((len(bits), len(bits)))
    np.fill_diagonal(bond, 0)
    free = list(range(len(bits)))
    groups = []
    for left in range(parts, 0, -1):
        size = -(-len(free) // left)
        group = [free.pop(int(np.argmax(bond[np.ix_(free, free)].max(axis=1))))]
        while len(group) < size:
            group.append(free.pop(int(np.argmax(bond[np.ix_(free, group)].sum(axis=1)))))
        groups.append(sorted(bits[i] for i in group))
    return groups


def part_values(values: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each fingerprint, closed up."""
    out = np.zeros(len(values), np.uint64)
    for i, bit in enumerate(bits):
        out |= ((values >> np.uint64(bit)) & ONE) << np.uint64(i)
    return out


def pair_costs(values: np.ndarray, bits: list[int], total: float, most: int) -> list[float]:
    """Estimated cost of a part for thresholds -1..most with `total` fingerprints.

    Candidates: the sample's pairs within the threshold in this part, scaled to all
    pairs; probes: one row for each value within the threshold.
    """
    own = part_values(values, bits)[:2_000]
    away = np.bitwise_count(own[:, None] ^ own[None, :])[np.triu_indices(len(own), 1)]
    near = np.bincount(away, minlength=BITS + 1)[: most + 1] if len(away) else np.zeros(most + 1)
    share = np.cumsum(near) / max(len(away), 1)
    costs = [0.0]
    for t in range(most + 1):
        probes = sum(comb(len(bits), k) for k in range(t + 1))
        # No sample pair met: as many as independent even bits would give.
        least = probes / 2.0 ** len(bits)
        candidates = max(share[t], least) * total * total / 2
        costs.append(0.05 * candidates + 30.0 * total * (1 + probes))
    return costs


def layout(values: np.ndarray, total: float, distance: int, bits: list[int]) -> list[tuple[list[int], int]]:
    """Parts and thresholds of the least estimated cost, as (bits, threshold >= 0)."""
    rows = bit_rows(values).astype(float)
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for parts in range(1, min(distance + 1, len(bits)) + 1):
        groups = group_bits(rows, bits, parts)
        goal = distance - parts + 1
        # least[s]: cost and thresholds of the parts so far, s = the sum of (threshold + 1).
        least: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for group in groups:
            costs = pair_costs(values, group, total, min(goal, 3) if goal > 0 else 0)
            after: dict[int, tuple[float, list[int]]] = {}
            for s, (spent, chosen) in least.items():
                for t, cost in enumerate(costs, start=-1):
                    if t > len(group):
                        continue
                    price = (spent + cost, [*chosen, t])
                    if s + t + 1 <= goal + parts and price[0] < after.get(s + t + 1, (np.inf,))[0]:
                        after[s + t + 1] = price
            least = after
        found = least.get(goal + parts)
        if found and (best is None or found[0] < best[0]):
            best = found[0], [(g, t) for g, t in zip(groups, found[1]) if t >= 0]
    return best[1] if best else [(bits, distance)]


def near_values(width: int, threshold: int) -> np.ndarray:
    """All patterns of 1..threshold set bits."""
    return np.array(
        [sum(1 << i for i in c) for k in range(1, threshold + 1) for c in combinations(range(width), k)],
        np.uint64,
    )


def span_links(values: np.ndarray, probe: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect what the group's links connect, a spanning set of them.

    `probe` marks rows that only probe; links need a row that is filed. Starting from a
    row, rows within the distance are reached and taken out; each is compared once with
    those not yet reached, so a tight group costs little more than one pass.
    """
    links = []
    left = np.arange(len(values))
    while len(left) > 1:
        front = [int(left[0])]
        left = left[1:]
        while front and len(left):
            at = front.pop()
            near = np.bitwise_count(values[left] ^ values[at]) <= distance
            if probe[at]:
                near &= ~probe[left]
            if near.any():
                met = left[near]
                links += [(at, int(m)) for m in met]
                front += met.tolist()
                left = left[~near]
    return links


def links(distinct: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect all within the distance.

    `distinct` (fingerprint) has no repeats. Every pair within the distance ends up in one
    component; every edge is such a pair.
    """
    total = distinct.count()
    share = min(1.0, 1.2 * settings.sample / max(total, 1))
    place = F.pmod(F.xxhash64("fingerprint", F.lit(7)), F.lit(1 << 30))
    sample = np.array(
        [
            r[0]
            for r in distinct.where(place < int(share * (1 << 30)))
            .limit(settings.sample)  # bounds the driver; only costs are estimated on it
            .collect()
        ],
        np.int64,
    ).view(np.uint64)

    def file(rows: DataFrame, parts: list[tuple[list[int], int]], level: int) -> DataFrame:
        """Rows (place, fingerprint, probe) for each part, below the place that a row had."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = batch.column(0).to_numpy().view(np.uint64)
                before = batch.column(1).to_numpy().view(np.uint64)
                probing = batch.column(2).to_numpy(zero_copy_only=False)
                for number, (bits, threshold) in enumerate(parts):
                    own = part_values(values, bits)
                    salt = np.uint64((0x9E3779B97F4A7C15 * (64 * level + number + 1)) % 2**64)
                    for mask in [np.uint64(0), *near_values(len(bits), threshold)]:
                        place = mix(mix(before + salt) ^ (own ^ mask))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(place.view(np.int64)),
                                pa.array(values.view(np.int64)),
                                pa.array(probing | (mask != 0)),
                            ],
                            ["place", "fingerprint", "probe"],
                        )

        return rows.select("fingerprint", "place", "probe").mapInArrow(
            run, "place long, fingerprint long, probe boolean"
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links within the runs of equal place; input is sorted by place."""
        rest: pa.Table | None = None

        def solve(piece: pa.Table) -> pa.RecordBatch:
            place = piece.column("place").to_numpy()
            values = piece.column("fingerprint").to_numpy().view(np.uint64)
            probe = piece.column("probe").to_numpy()
            edges = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1], [True])))
            size = np.diff(edges)
            a, b = [], []
            for begin in edges[:-1][size == 2].tolist():  # most groups, without numpy's overhead below
                a.append(begin)
                b.append(begin + 1)
            if a:
                i, j = np.array(a), np.array(b)
                good = (np.bitwise_count(values[i] ^ values[j]) <= settings.distance) & ~(probe[i] & probe[j])
                a, b = i[good].tolist(), j[good].tolist()
            for begin, end in zip(edges[:-1][size > 2].tolist(), edges[1:][size > 2].tolist()):
                for x, y in span_links(values[begin:end], probe[begin:end], settings.distance):
                    a.append(begin + x)
                    b.append(begin + y)
            signed = values.view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(signed[np.array(a, int)]), pa.array(signed[np.array(b, int)])], ["a", "b"]
            )

        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            place = rest.column("place").to_numpy()
            whole = int(np.searchsorted(place, place[-1]))
            if whole:
                yield solve(rest.slice(0, whole))
                rest = rest.slice(whole)
        if rest is not None and rest.num_rows:
            yield solve(rest)

    def in_blocks(rows: DataFrame) -> DataFrame:
        """Rows of hot places, each with its block's number in a place for every two blocks."""
        half = max(settings.split // 2, 1)
        parted = rows.withColumn("blocks", F.ceil(F.col("n") / half)).withColumn(
            "own", F.pmod(F.xxhash64("fingerprint", F.lit(11)), F.col("blocks"))
        )
        others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda x: x != F.col("own"))
        both = parted.withColumn("other", F.explode(others))
        return both.select(
            F.xxhash64("place", F.least("own", "other"), F.greatest("own", "other")).alias("place"),
            "fingerprint",
            "probe",
        )

    rows = distinct.select(
        "fingerprint", F.lit(0).cast("long").alias("place"), F.lit(False).alias("probe")
    )
    bits = list(range(BITS))
    found = None
    level = 0
    while True:
        parts = layout(sample, total, settings.distance, bits)
        filed = stored(file(rows, parts, level).distinct() if level else file(rows, parts, level), "filed")
        sizes = filed.groupBy("place").agg(F.count("*").alias("n"))
        hot = stored(sizes.where(F.col("n") > settings.split), "hot-places")
        any_hot = not hot.isEmpty()
        last = level >= 3
        calm = filed.join(hot, "place", "left_anti") if any_hot else filed
        if any_hot and last:
            calm = calm.select("place", "fingerprint", "probe").union(in_blocks(filed.join(hot, "place")))
        edges = (
            calm.repartition("place")
            .sortWithinPartitions("place", "probe", "fingerprint")
            .mapInArrow(compare, "a long, b long")
        )
        found = edges if found is None else found.union(edges)
        if not any_hot or last:
            return found
        # File the rows of hot places anew, below their place, by all bits parted otherwise.
        rows = filed.join(hot, "place", "left_semi")
        level += 1
        shuffled = np.random.default_rng(level).permutation(BITS).tolist()
        bits = shuffled
        sample = sample[:0]


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of `docs` (doc_id, text).

    fingerprint is a signed long; component_id the smallest doc_id that links reach, the
    own one included. Null and empty texts have fingerprint 0 and are linked like any
    other. Null doc_ids stay null and take part through their fingerprint; component_id
    is null only if no document of the component has an id. Repeated rows fall into one
    component. An empty table gives no rows. Other columns are left out.
    """
    prints, named = components_of(docs, settings)
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def components_of(docs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Every row's (doc_id, fingerprint), and (fingerprint, component_id, root) of each fingerprint."""
    prints = stored(fingerprints(docs, settings), "fingerprints")
    least = stored(
        prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")), "distinct-fingerprints"
    )
    roots = components(links(least.select("fingerprint"), settings))
    member = stored(
        least.join(roots, least["fingerprint"] == roots["vertex"], "left").select(
            "fingerprint", "least_id", F.coalesce("root", "fingerprint").alias("root")
        ),
        "members",
    )
    ids = stored(member.groupBy("root").agg(F.min("least_id").alias("component_id")), "component-ids")
    named = member.join(ids, "root").select("fingerprint", "component_id", "root")
    return prints, stored(named, "named-fingerprints")


def keep_first(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of `docs` with one row of each component, that of the smallest doc_id.

    Of rows with that doc_id in the component, the one whose text has the smallest SHA-256
    stays. Rows without a doc_id cannot be named and stay. Null and empty texts have fingerprint 0 and
    are linked like any other, an empty table gives no rows. All columns stay as they are, also
    where their names repeat or clash.
    """
    prints, named = components_of(docs, settings)
    found = prints.join(named, "fingerprint").where("doc_id is not null")
    ids = stored(
        found.groupBy("doc_id").agg(F.min("component_id").alias("first"), F.count("*").alias("n")),
        "members-by-id",
    )
    # Columns by place, and the id once more as a long.
    plain = by_place(docs)
    columns, text = plain.columns, F.col(f"_{place(docs, 'text')}")
    rows = plain.withColumn("doc_id", F.col(f"_{place(docs, 'doc_id')}").cast("long"))
    # Ids of several rows are decided by row, as their texts may be in different components.
    dropped = ids.where("doc_id <> first and n = 1").select("doc_id")
    repeated = ids.where("n > 1").select("doc_id")
    # Sorted and merged at every size: the list of dropped documents grows with the corpus.
    left = rows.join(dropped.hint("merge"), "doc_id", "left_anti")
    if repeated.isEmpty():
        return left.select(*columns).toDF(*docs.columns)
    several = rows.join(repeated.hint("merge"), "doc_id", "left_semi")
    whole = several.select("doc_id", text.alias("text"), F.struct(*columns).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t, settings.shingle, settings.seed) for t in batch.column(1).to_pylist()]
            own = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, own], [*batch.schema.names, "fingerprint"])

    kind = StructType([*whole.schema.fields, StructField("fingerprint", LongType())])
    once = (
        whole.mapInArrow(run, kind)
        .join(named.where("component_id is not null"), "fingerprint")
        .where("doc_id = component_id")
        .groupBy("root")
        .agg(F.min_by("row", F.coalesce(F.sha2("text", 256), F.lit(""))).alias("row"))
        .select("row.*")
    )
    rest = left.join(repeated.hint("merge"), "doc_id", "left_anti").select(*columns)
    return rest.union(once).toDF(*docs.columns)


def hexadecimal(fingerprint: str) -> Column:
    """A signed long as 16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))

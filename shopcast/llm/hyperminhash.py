"""MinHash near-duplicates with compressed registers (operator 2).

Method: HyperMinHash. The shingle hashes of a document fall into ``REGISTERS``
buckets by their upper bits; a bucket keeps its least hash as a 16-bit number:
leading zeros (6 bits) and the ``MANTISSA`` bits after the first one. An empty
bucket takes the register of the first originally filled one that it probes
(densification), so that a band of ``ROWS`` registers meets with probability
J ** ``ROWS``: 32 bands miss a pair of similarity 0.75 with probability 6e-6.
Documents that share a band are candidates; the share of equal registers,
corrected for chance collisions, discards hopeless ones; full sets confirm the
others. Sets of up to ``SMALL`` shingles, whose few values make bands fail
together, have exact keys too: their rarest shingles, as many as no similar
pair can miss (prefix filter over one order of all shingles: frequent ones of
small sets last, by a bounded table of the most frequent, ties and others by
hash). So a line that many short documents share is no key of them.

Groups of any size, without all their pairs: equal sets are one node, numbered
by 64 bits of their digest. Keys are sorted by (key, node) over range
partitions, which split a hot key; a node meets the first node of its key
there, the same one in most keys of a group, and first nodes meet at the
partitions' borders. After components of the confirmed links, only keys that
still hold different components go on, and there only the nodes outside the
key's largest component meet its members, in blocks of bounded size: under
band keys by register estimate, then, for rows that passed, on full sets; under
prefix keys by sizes and places of the key, then on full sets. A task compares
its blocks in place and hands on one link per node and component. Keys that
hold many unlike documents of other components (a band that half-alike texts
share) still cost their pairs of comparisons there, not rows.

Defined results: a null text is empty: 0 shingles, linked with nothing, also
not with another empty one; texts of equal doc_id are one document for
``near_duplicates``, those without words aside; a null id never becomes a
component id and keeps null; an empty table gives an empty result;
other columns are ignored by ``near_duplicates`` and kept by ``deduplicate``,
which decides by text: of rows with one id each unlike text stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcast.llm.common import forget, free_names, map_texts, nothing, shared, text_rows
from shopcast.llm.shingles import U, mix, overlap, shingle_set, similar

REGISTERS, ROWS, MANTISSA = 128, 4, 10
BANDS = REGISTERS // ROWS
PERCENT = 75
#: Shingles of sets whose pairs are found exactly.
SMALL = 64
#: Rows per Arrow batch where each carries two full sets.
WIDE_ROWS = 1000
BLOCK = 2048
#: Shingles of small sets that are ordered by frequency, and least frequency.
FREQUENT, LEAST_FREQUENT = 1 << 18, 8
#: Place of a key that is a band, of a set that has prefix keys too or not.
BAND, BAND_BESIDE = -1, -2
#: Collisions of registers by chance, as a share of the registers (equal set sizes).
CHANCE = 0.1699 / (1 << MANTISSA)

_LOOK = mix(np.arange(256 * REGISTERS, dtype=U) + U(77)).astype(np.int64).reshape(256, REGISTERS) % REGISTERS


def registers(hashes: np.ndarray) -> np.ndarray:
    """Registers of a non-empty sorted set, empty buckets filled."""
    bits = REGISTERS.bit_length() - 1
    bucket = (hashes >> U(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    rest = hashes[first] << U(bits) | U((1 << bits) - 1)
    exponent = np.frexp(rest.astype(np.float64))[1]
    zeros = np.minimum(64 - exponent, 63)
    kept = (rest << zeros.astype(U) << U(1)) >> U(64 - MANTISSA)
    out = np.full(REGISTERS, -1, np.int64)
    out[bucket[first]] = (zeros << MANTISSA) | kept.astype(np.int64)
    empty = np.flatnonzero(out < 0)
    if len(empty):
        filled = out >= 0
        look = _LOOK[:, empty]
        probe = look[filled[look].argmax(axis=0), np.arange(len(empty))]
        out[empty] = np.where(filled[probe], out[probe], out.max())
    return out.astype("<u2")


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of a registers row; its low bits are the band,
    below ``BANDS``."""
    rows = regs.reshape(BANDS, ROWS).astype(U)
    key = np.arange(BANDS, dtype=U) * U(0xA0761D6478BD642F) + U(1)
    for i in range(ROWS):
        key = mix(key ^ rows[:, i])
    return ((key & ~U(2 * BANDS - 1)) | np.arange(BANDS, dtype=U)).view(np.int64)


def has_prefix(n: int, percent: int = PERCENT, small: int = SMALL) -> bool:
    """Whether a set of ``n`` shingles may be similar to one of ``small``."""
    return percent * n <= 100 * small


def least_overlap(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Common shingles that similar sets of these sizes have at least."""
    return -(-percent * (a + b) // (100 + percent))


class Frequencies:
    """Frequent shingles and their counts; others count 0."""

    def __init__(self, shingles: np.ndarray, counts: np.ndarray):
        order = np.argsort(shingles)
        self.shingles, self.counts = shingles[order], counts[order]

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.shingles):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.shingles, hashes), len(self.shingles) - 1)
        return np.where(self.shingles[at] == hashes, self.counts[at], 0)


def prefix_keys(hashes: np.ndarray, frequencies: Frequencies, percent: int = PERCENT) -> np.ndarray:
    """Keys of a set's rarest shingles, in order, with low bits ``BANDS``."""
    n = len(hashes)
    mixed = mix(hashes)
    rarest = mixed[np.lexsort((mixed, frequencies.of(hashes)))[:n - (percent * n + 99) // 100 + 1]]
    return ((rarest & ~U(2 * BANDS - 1)) | U(BANDS)).view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Corrected Jaccard estimate of register rows (last axis)."""
    return ((a == b).mean(axis=-1) - CHANCE) / (1 - CHANCE)


def least_estimate(n_small: np.ndarray, percent: int) -> np.ndarray:
    """Estimates below this are over five standard deviations from the
    threshold; those of small sets discard nothing."""
    t = percent / 100
    eff = REGISTERS * (1 - np.exp(-np.maximum(n_small, 1) / REGISTERS))
    return np.where(n_small <= SMALL, -1.0, t - 5.5 * np.sqrt(t * (1 - t) / eff))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node, bands, small) of every row; small:
    the set where it has prefix keys. No node without words."""
    def make():
        def one(keys, texts):
            out = {"doc_id": [k["id"] for k in keys], "text_hash": [k["hash"] for k in keys], "n_shingles": [], "node": [], "bands": [], "small": []}
            for t in texts:
                s = shingle_set(t)
                out["n_shingles"].append(len(s))
                out["node"].append(node_of(s) if len(s) else None)
                out["bands"].append(band_keys(registers(s)) if len(s) else None)
                out["small"].append(s.tobytes() if len(s) and has_prefix(len(s), percent) else None)
            return out
        return one, nothing
    rows = text_rows(docs, id_col, text_col).select(F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash")).alias("key"), "text")
    return map_texts(rows, make, "doc_id long, text_hash long, n_shingles long, node long, bands array<long>, small binary")


def node_of(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def frequent_shingles(sets: DataFrame, col: str = "small", least: int = LEAST_FREQUENT) -> Frequencies:
    """The most frequent shingles of the sets, at most ``FREQUENT`` of those
    that ``least`` sets hold."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, n = np.unique(np.frombuffer(b"".join(x for x in b.column(col).to_pylist() if x), "<u8"), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["shingle", "n"])

    found = sets.select(col).mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = found.where(F.col("n") >= least).orderBy(F.col("n").desc(), "shingle").limit(FREQUENT).toPandas()
    return Frequencies(top["shingle"].to_numpy(np.int64).view(U), top["n"].to_numpy(np.int64))


KEYS = "key long, node long, at int"


def candidate_keys(nodes: DataFrame, frequencies: Frequencies, percent: int) -> DataFrame:
    """(key, node, at) of nodes with bands and small: band keys, and prefix
    keys with their place."""
    given = nodes.sparkSession.sparkContext.broadcast(frequencies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, node, at = [], [], []
            for n, bands, small in zip(b.column("node").to_pylist(), b.column("bands"), b.column("small").to_pylist()):
                own, place = bands.values.to_numpy(), np.full(BANDS, BAND)
                if small is not None:
                    h = np.frombuffer(small, "<u8")
                    rarest = prefix_keys(h, given.value, percent)
                    place = np.concatenate([np.full(BANDS, BAND_BESIDE if len(h) <= SMALL else BAND), np.arange(len(rarest))])
                    own = np.concatenate([own, rarest])
                key.append(own)
                at.append(place)
                node.append(np.full(len(own), n))
            if key:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(key)), pa.array(np.concatenate(node)),
                                                  pa.array(np.concatenate(at).astype(np.int32))], ["key", "node", "at"])

    return nodes.select("node", "bands", "small").mapInArrow(run, KEYS)


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, component) of the nodes of ``links`` (a, b): the least node that
    each reaches. Labels spread along links and jump to their labels' labels;
    every round is a shared table."""
    both = shared(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), f"{name}-links")
    label = both.groupBy("a").agg(F.least(F.min("a"), F.min("b")).alias("label")).select(F.col("a").alias("node"), "label")
    label = shared(label, f"{name}-label")
    while True:
        near = both.join(label.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near"))
        step = label.join(near, "node", "left").withColumn("near", F.least("label", "near"))
        # A label whose members saw a lower one moves there, with all its members.
        down = step.groupBy(F.col("label").alias("root")).agg(F.min("near").alias("down"))
        step = step.join(down, F.col("label") == F.col("root")).withColumn("next", F.least("near", "down"))
        jump = step.select(F.col("node").alias("root"), F.col("next").alias("far"))
        step = step.drop("root").join(jump, F.col("next") == F.col("root"), "left")
        new = shared(step.select("node", F.least("next", "far").alias("label"), F.col("label").alias("was")), f"{name}-label")
        moved = new.where("label < was").limit(1).count()
        label = new.select("node", "label")
        if not moved:
            return label.select("node", F.col("label").alias("component"))


def confirm(pairs: DataFrame, sets: DataFrame, percent: int, small_sets: bool = False) -> DataFrame:
    """The pairs (a, b) whose full sets are similar. Unless sets are small, a
    pair first meets the registers of both, and only what passes the estimate
    meets the sets."""

    def plausible(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            small, large = np.minimum(p.n_a, p.n_b), np.maximum(p.n_a, p.n_b)
            a = np.frombuffer(b"".join(p.r_a), "<u2").reshape(-1, REGISTERS)
            b = np.frombuffer(b"".join(p.r_b), "<u2").reshape(-1, REGISTERS)
            ok = (small * 100 >= percent * large) & (estimate(a, b) >= least_estimate(small.to_numpy(), percent))
            yield p.loc[ok, ["a", "b"]]

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            ok = []
            for x, y in zip(p.s_a, p.s_b):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                n = overlap(x, y)
                ok.append(100 * n >= percent * (len(x) + len(y) - n))
            yield p.loc[np.array(ok, bool), ["a", "b"]]

    def sided(cols: DataFrame, side: str) -> DataFrame:
        return cols.toDF(*[side if c == "node" else f"{c[0]}_{side}" for c in cols.columns])

    if not small_sets:
        narrow = sets.select("node", "n_shingles", "registers")
        pairs = pairs.join(sided(narrow, "a"), "a").join(sided(narrow, "b"), "b").mapInPandas(plausible, "a long, b long")
    full = sets.select("node", "set")
    return pairs.join(sided(full, "a"), "a").join(sided(full, "b"), "b").mapInPandas(exact, "a long, b long")


def in_blocks(rows: DataFrame, payload: list[str]) -> DataFrame:
    """(key, x, y, query, node, component, at, payload): blocks (x) of a key's
    members beside blocks (y) of its nodes outside the main component.
    ``rows``: key, node, component, at, main, payload."""
    out = F.col("component") != F.col("main")
    size = rows.groupBy("key").agg(F.count("*").alias("members"), F.sum(out.cast("long")).alias("outs")).where("outs > 0")
    rows = rows.join(size, "key")
    for name, n in (("x", "members"), ("y", "outs")):
        blocks = F.ceil(F.col(n) / BLOCK).cast("int")
        rows = rows.withColumn(f"{name}s", blocks).withColumn(name, F.pmod(F.xxhash64("node"), F.col(f"{name}s")).cast("int"))
    cols = ["node", "component", "at", *payload]
    each = {n: F.explode(F.sequence(F.lit(0), F.col(f"{n}s") - 1)).alias(n) for n in ("x", "y")}
    members = rows.select("key", "x", each["y"], F.lit(False).alias("query"), *cols)
    return members.unionByName(rows.where(out).select("key", each["x"], "y", F.lit(True).alias("query"), *cols))


def common_counts(held: list[np.ndarray]):
    """A function that counts what a sorted set shares with each held set, in
    one pass over all of them."""
    size = np.array([len(s) for s in held])
    vocabulary, flat = np.unique(np.concatenate(held), return_inverse=True)
    start = np.cumsum(size) - size

    def count(s: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(vocabulary, s), len(vocabulary) - 1)
        mark = np.zeros(len(vocabulary), np.int64)
        mark[at[vocabulary[at] == s]] = 1
        return np.add.reduceat(mark[flat], start)
    return size, count


def linked_in_blocks(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between nodes of one key and different components, on full
    sets: one per node outside the main component, block and component. Under a
    prefix key (``at`` from 0) only pairs whose shingles from the key on suffice.
    ``rows`` as in ``in_blocks``, with set."""
    def meet(g: pd.DataFrame) -> pd.DataFrame:
        q, m = g[g["query"]], g[~g["query"]]
        found = []
        if len(q) and len(m):
            size, count = common_counts([np.frombuffer(s, "<u8") for s in m["set"]])
            comps, nodes, at = m.component.to_numpy(), m.node.to_numpy(), m["at"].to_numpy()
            for node, comp, place, s in zip(q.node, q.component, q["at"], q["set"]):
                s = np.frombuffer(s, "<u8")
                ok = (comps != comp) & (np.minimum(size, len(s)) * 100 >= percent * np.maximum(size, len(s)))
                if place >= 0:
                    ok &= np.minimum(size - at, len(s) - place) >= least_overlap(size, len(s), percent)
                if not ok.any():
                    continue
                common = count(s)
                hit = np.flatnonzero(ok & (100 * common >= percent * (size + len(s) - common)))
                for i in hit[np.unique(comps[hit], return_index=True)[1]]:
                    found.append((min(node, nodes[i]), max(node, nodes[i])))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return in_blocks(rows, ["set"]).groupBy("key", "x", "y").applyInPandas(meet, "a long, b long").distinct()


def linked_in_small_blocks(rows: DataFrame, percent: int, sets: DataFrame | None = None) -> DataFrame:
    """As ``linked_in_blocks``, for very many keys of few members: sorted rows
    stream through a task, which holds one block at a time. The blocks are made
    of narrow rows, so the sets (``sets``: node, set; else those of ``rows``)
    move with their block only."""
    sets = rows.select("node", "set").dropDuplicates(["node"]) if sets is None else sets
    cols = ["key", "x", "y", "query", "node", "component", "at", "set"]

    def meet(block: list[tuple]) -> list[tuple[int, int]]:
        members = [r for r in block if not r[0]]
        sets = {r[1]: np.frombuffer(r[4], "<u8") for r in block}
        sizes, comps, at = (np.array(c, np.int64) for c in ([len(sets[r[1]]) for r in members], [r[2] for r in members], [r[3] for r in members]))
        found, count = [], None
        for query, node, comp, place, _ in block:
            if not query or not members:
                continue
            s = sets[node]
            ok = (comps != comp) & (np.minimum(sizes, len(s)) * 100 >= percent * np.maximum(sizes, len(s)))
            if place >= 0:
                ok &= np.minimum(sizes - at, len(s) - place) >= least_overlap(sizes, len(s), percent)
            hit = np.flatnonzero(ok)
            if len(hit) > 16:
                if count is None:
                    count = common_counts([sets[r[1]] for r in members])[1]
                common = count(s)
                hit = hit[100 * common[hit] >= percent * (sizes[hit] + len(s) - common[hit])]
            else:
                hit = np.array([i for i in hit.tolist() if similar(s, sets[members[i][1]], percent)], np.int64)
            for i in hit[np.unique(comps[hit], return_index=True)[1]].tolist():
                found.append((min(node, members[i][1]), max(node, members[i][1])))
        return found

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, block = None, []

        def out(links):
            return pa.RecordBatch.from_arrays([pa.array([k[i] for k in links], pa.int64()) for i in (0, 1)], ["a", "b"])
        for batch in batches:
            found = []
            for key, x, y, *row in zip(*(batch.column(c).to_pylist() for c in cols)):
                if (key, x, y) != own:
                    if len(block) > 1:
                        found += meet(block)
                    own, block = (key, x, y), []
                block.append(row)
            yield out(found)
        yield out(meet(block) if len(block) > 1 else [])

    spread = in_blocks(rows, []).join(sets, "node").select(*cols).repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    return spread.mapInArrow(stream, "a long, b long").distinct()


def plausible_rows(rows: DataFrame, percent: int) -> DataFrame:
    """(key, node): rows of a band key that may have a link to another component
    there, by registers. A pair counts in the first band that it shares only.
    ``rows`` as in ``in_blocks``, with n_shingles and registers."""
    def meet(g: pd.DataFrame) -> pd.DataFrame:
        q, m = g[g["query"]], g[~g["query"]]
        regs = np.frombuffer(b"".join(m.registers), "<u2").reshape(-1, REGISTERS)
        comps, sizes, nodes = m.component.to_numpy(), m.n_shingles.to_numpy(), m.node.to_numpy()
        keep, asked = np.zeros(len(m), bool), []
        key = g["key"].iloc[0]
        band = int(key) & (2 * BANDS - 1)
        for node, comp, n, r in zip(q.node, q.component, q.n_shingles, q.registers):
            small, large = np.minimum(sizes, n), np.maximum(sizes, n)
            ok = (comps != comp) & (small * 100 >= percent * large)
            same = regs[ok] == np.frombuffer(r, "<u2")
            first = same.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1)
            ok[ok] = ((same.mean(axis=1) - CHANCE) / (1 - CHANCE) >= least_estimate(small[ok], percent)) & (first == band)
            if ok.any():
                keep |= ok
                asked.append(node)
        found = np.unique(np.concatenate([nodes[keep], np.array(asked, np.int64)]))
        return pd.DataFrame({"key": np.full(len(found), key), "node": found}, dtype="int64")

    return in_blocks(rows, ["n_shingles", "registers"]).groupBy("key", "x", "y").applyInPandas(
        meet, "key long, node long").distinct()


MEET = KEYS + ", first long, edge boolean"


def meeting_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (key, node): the different nodes of keys with several,
    each with the first one. The first nodes of a partition's first and last key
    come once more as ``edge``, since their keys may go on in another one."""
    def made(key, node, at, first, edge):
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(node), pa.array(at, pa.int32()), pa.array(first), pa.array(np.full(len(key), edge))],
                                          [f.split()[0] for f in MEET.split(", ")])

    head, sent, last = None, False, None      # the run's first row, whether it went out, the last node
    for batch in batches:
        cols = [np.asarray(batch.column(c)) for c in ("key", "node", "at")]
        if not len(cols[0]):
            continue
        if head is None:
            yield made(*(c[:1] for c in cols), cols[1][:1], True)
        else:
            cols = [np.concatenate([[h], c]) for h, c in zip(head, cols)]
        key, node, at = cols
        before = node[:-1].copy()
        if head is not None:
            before[:1] = last
        new = np.concatenate([[True], key[1:] != key[:-1]])
        keep = new | np.concatenate([[True], node[1:] != before])
        end = node[-1]
        key, node, at, new = (c[keep] for c in (key, node, at, new))
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(key)))
        which = np.cumsum(new) - 1
        out = size[which] > 1
        if head is not None and sent:
            out[0] = False
        sent = bool(size[-1] > 1 or (len(begin) == 1 and head is not None and sent))
        i = begin[-1]
        head, last = (key[i], node[i], at[i]), end
        yield made(key[out], node[out], at[out].astype(np.int32), node[begin[which]][out], False)
    if head is not None:
        yield made(*(np.array([h]) for h in head), np.array([head[1]]), True)


def meetings(rows: DataFrame, name: str) -> DataFrame:
    """The (key, node, at) rows of keys with several nodes, with the first of
    them in their partition."""
    spread = rows.repartitionByRange("key", "node").sortWithinPartitions("key", "node")
    return shared(spread.mapInArrow(meeting_rows, MEET), f"{name}-meet")


def first_pairs(meet: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b: nodes and the first ones of their keys, and those of
    keys that lie in several partitions."""
    own = meet.where("not edge").select("node", F.col("first").alias("other"))
    edges = meet.where("edge").groupBy("key").agg(F.min("node").alias("other"), F.collect_set("node").alias("nodes")).select(
        F.explode("nodes").alias("node"), "other")
    both = own.unionByName(edges).where("node <> other")
    return both.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def link_nodes(meet: DataFrame, sets: DataFrame, percent: int, name: str, small_sets: bool = False) -> DataFrame:
    """(node, component) of the nodes with a confirmed link to another one.
    ``small_sets``: full sets are as cheap to move as registers."""
    links = shared(confirm(shared(first_pairs(meet), f"{name}-pairs"), sets, percent, small_sets), f"{name}-links", WIDE_ROWS)
    comp = components(links, name)
    # Keys whose pairs the first nodes did not all see, if they hold several components.
    wide = meet.where(F.col("at") != BAND_BESIDE).select("key", "node", "at").join(comp, "node", "left")
    wide = shared(wide.withColumn("component", F.coalesce("component", "node")), f"{name}-wide")
    counts = wide.groupBy("key", "component").agg(F.count("*").alias("n"))
    main = counts.groupBy("key").agg(F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("kinds"), F.sum("n").alias("members"))
    main = main.where("kinds > 1 and members > 2").select("key", F.col("top.component").alias("main"))
    every, wide = wide, shared(wide.join(main, "key"), f"{name}-rest")
    forget(every)
    full = sets.select("node", "set")
    if small_sets:
        more = linked_in_small_blocks(wide, percent, full)
    else:
        more = linked_in_blocks(wide.where("at >= 0").join(full, "node"), percent)
        bands = wide.where(F.col("at") == BAND)
        rows = shared(plausible_rows(bands.join(sets.select("node", "n_shingles", "registers"), "node"), percent), f"{name}-plausible")
        more = more.unionByName(linked_in_blocks(bands.join(rows, ["key", "node"]).join(full, "node"), percent))
    more = shared(more, f"{name}-links", WIDE_ROWS)
    if not more.limit(1).count():
        return comp
    return components(links.unionByName(more), name)


def shingle_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Full sets and registers of the documents in ``wanted`` (doc_id, least of
    a node's)."""
    rows = text_rows(docs, id_col, text_col).join(wanted.select("doc_id"), "doc_id", "left_semi")

    def make():
        def one(keys, texts):
            sets = [s for s in map(shingle_set, texts) if len(s)]
            return {"node": list(map(node_of, sets)), "n_shingles": list(map(len, sets)),
                    "registers": [registers(s).tobytes() for s in sets], "set": [s.tobytes() for s in sets]}
        return one, nothing
    return map_texts(rows, make, "node long, n_shingles long, registers binary, set binary")


def labelled(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_shingles, node, label) of every row: rows of one
    label are near duplicates, by text; no label without words or id."""
    sig = shared(signatures(docs, id_col, text_col, percent), "near-signatures")
    nodes = sig.where("node is not null and doc_id is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), F.first("small").alias("small"))
    nodes = shared(nodes, "near-nodes")
    frequencies = frequent_shingles(nodes.where("small is not null"))
    meet = meetings(candidate_keys(nodes, frequencies, percent), "near")
    wanted = nodes.select("node", "doc_id").join(meet.select("node").distinct(), "node", "left_semi")
    sets = shingle_sets(docs, wanted.select("doc_id").distinct(), id_col, text_col)
    # Ids that repeat bring the sets of other nodes, or one twice.
    sets = shared(sets, "near-sets", 2 * WIDE_ROWS)
    twice = shared(sets.groupBy("node").count().where("count > 1").select("node"), "near-again")
    if twice.limit(1).count():
        sets = shared(sets.dropDuplicates(["node"]), "near-sets", 2 * WIDE_ROWS)
    comp = link_nodes(meet, sets, percent, "near")
    label = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node")).alias("label")
    return shared(sig.drop("bands", "small").join(comp, "node", "left").select("doc_id", "text_hash", "n_shingles", "node", label), "near-labels")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    rows = labelled(docs, percent, id_col, text_col)
    # Texts of one id join their labels.
    ids = rows.where("label is not null").groupBy("doc_id").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b")
    ids = shared(ids.select("doc_id", "a"), "near-ids")
    if ids.limit(1).count():
        links = rows.join(ids, "doc_id").select("a", F.col("label").alias("b")).where("a <> b").distinct()
        comp = components(links, "near-ids").withColumnRenamed("node", "label")
        rows = rows.join(comp, "label", "left").withColumn("label", F.coalesce("component", "label")).drop("component")
    least = rows.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    out = rows.join(least, "label", "left")
    component = F.coalesce("least", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near duplicates, the one of
    least (doc_id, hash of the text), all columns; of equal rows of one id the
    first stays, and so does each text of it that is like no other."""
    rows = labelled(docs, percent, id_col, text_col)
    gone_id, gone_text = free_names(docs, "gone_id", "gone_text")
    first = rows.where("label is not null").groupBy("label").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    gone = rows.join(first, "label").where(F.struct("doc_id", "text_hash") != F.col("first"))
    gone = gone.select(F.col("doc_id").alias(gone_id), F.col("text_hash").alias(gone_text)).distinct()
    text = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    # One way at every size: without the hint a small corpus would broadcast, a large one sort its texts.
    out = docs.join(gone.hint("shuffle_hash"), (F.col(id_col).cast("long") == F.col(gone_id)) & (text == F.col(gone_text)), "left_anti")
    again = rows.where("doc_id is not null").groupBy(F.col("doc_id").alias(gone_id), F.col("text_hash").alias(gone_text)).count().where("count > 1")
    again = shared(again.drop("count"), "near-again")
    if not again.limit(1).count():
        return out
    same = (F.col(id_col).cast("long") == F.col(gone_id)) & (text == F.col(gone_text))
    return out.join(again, same, "left_anti").unionByName(out.join(again, same, "left_semi").dropDuplicates([id_col, text_col]))

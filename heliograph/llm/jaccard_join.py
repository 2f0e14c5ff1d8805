"""Near duplicates: all pairs of shingle sets with Jaccard similarity of at least 0.8, as components.

Method (universe-partition pigeonhole). Sizes a <= b of linked sets satisfy b <= 1.25 a, and their
sets differ in at most H = (a + b) / 9 tokens. Tokens are hashed into m segments, m set by the size
band (a power of two), so at least one segment that isn't empty in a set is equal in both, as long
as the set has more than H such segments. Sets at a band's lower edge also take part in the band
below, where their smaller partners are.

Cost-based allocation: a set's segments are ordered by one global order (rarest first: a segment is
as frequent as its rarest token; then by most tokens, then by hash), and only its first H + 1 are
indexed. By the prefix principle two linked sets still share one of them. Token frequencies come
from a table of at most 2**HOT_BITS heavy hitters; they steer the order only, never the result.
Sets with too few segments (small ones) index all their segments and the one-deletion neighbourhood
of each, which finds segments that differ in one token; where even that can't reach H + 1 they
index their single tokens.

Sets are nodes: documents with equal sets are one node from the start. A group of nodes under one
signature is never expanded into all its pairs. Its task compares bit parities (an exact lower bound
of the difference, with bits in proportion to the set), takes what passes as linked for the moment,
and so proposes about one pair for each node that it adds to a component. Every proposed pair is
verified on the documents' own words. Pairs that turn out not to be linked go back to the groups that
proposed them, which propose others in the next round, eight times as many for two components that a proposal
failed to join. It ends when no group has a pair of different components left that could be linked.
Groups of more than BLOCK nodes are dealt to tasks by blocks: each block alone in the first round,
pairs of blocks while parts of them are still in different components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliograph.llm import textvec
from heliograph.llm.common import text_of
from heliograph.runtime import discard, saved, ship_code

WORDS = 5
HOT_BITS = 18
HOT_LEAST = 64
PARITY_BITS = 1024  # at least; sets of more than half as many tokens have a second, wider row of bits
CHUNK = 256  # members of a hub that one task compares at most
BLOCK = 4096  # nodes of a group that one task holds at most, or twice as many
SMALL = 6  # groups up to this size are compared by array operations over all of them
QUOTA = 8  # how much faster proposals between two components grow from round to round
HOT_TOKENS = 1 << 21
SEEN_NODES = 1 << 19
SENT_IDS = 1 << 18  # documents whose ids are broadcast at most, so that other texts aren't shuffled


def differences(n: int) -> int:
    """H: the most tokens in which a set of n tokens differs from any set it links with."""
    return (n + n * 5 // 4) // 9


def token_sets(data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document of a block."""
    small = textvec.LOWER[data]
    at, to = textvec.word_spans(small)
    hashes = textvec.span_hashes(small, at, to)
    bounds = np.searchsorted(at, np.append(starts, len(data)))
    windows = textvec.window_hashes(hashes, WORDS)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= WORDS:
            out.append(np.unique(windows[a : b - WORDS + 1]))
        elif b > a:
            out.append(textvec.window_hashes(hashes[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def node_of(tokens: np.ndarray) -> int:
    """A set's number: 64 bits of its content."""
    with np.errstate(over="ignore"):
        total = np.add.reduce(textvec.mix(tokens), dtype=np.uint64) + np.uint64(len(tokens))
    return int(textvec.mix(np.asarray([total], np.uint64)).view(np.int64)[0])


def parities(tokens: np.ndarray, bits: int = PARITY_BITS) -> bytes:
    """Parities of the tokens by their value modulo `bits`; sets that differ in d tokens differ in at most d of them."""
    return np.packbits(np.bincount((tokens % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).tobytes()


def wide_parities(tokens: np.ndarray) -> bytes | None:
    """At least two bits a token, in a power of two, where PARITY_BITS are fewer."""
    bits = 1 << (2 * len(tokens) - 1).bit_length() if len(tokens) else 0
    return parities(tokens, bits) if bits > PARITY_BITS else None


def least_difference(a: bytes, b: bytes) -> int:
    """How many wide parities differ; the wider row is folded."""
    x, y = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


class Heat:
    """Frequencies of heavy tokens: sorted tokens and their counts."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        order = np.argsort(tokens)
        self.tokens, self.counts = tokens[order], counts[order]

    def of(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(tokens), np.int64)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, self.counts[at], 0)


def signatures(tokens: np.ndarray, heat: Heat) -> list[np.ndarray]:
    """The signatures that a set indexes, in its own band and, at its lower edge, in the one below."""
    n = len(tokens)
    limit = differences(n)
    if not limit:
        return []  # linked with equal sets only
    band = n.bit_length() - 1
    return [_band_signatures(tokens, heat, b, limit) for b in ([band, band - 1] if 4 * n < 5 << band else [band])]


def _band_signatures(tokens: np.ndarray, heat: Heat, band: int, limit: int) -> np.ndarray:
    m = max(2, (3 << band) // 4)
    mixed = textvec.mix(tokens ^ np.uint64(0x5851F42D4C957F2D))
    segment = (mixed % np.uint64(m)).astype(np.int64)
    order = np.argsort(segment, kind="stable")
    segment, content = segment[order], textvec.mix(mixed + np.uint64(band))[order]
    begin = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
    size = np.diff(np.append(begin, len(segment)))
    with np.errstate(over="ignore"):
        total = np.add.reduceat(content, begin)
        place = (segment[begin].astype(np.uint64) << np.uint64(8)) + np.uint64(band)
        sign = textvec.mix(total ^ textvec.mix(place + (size.astype(np.uint64) << np.uint64(44))))
        if len(sign) > limit:
            if len(sign) == limit + 1:
                return sign
            cost = np.minimum.reduceat(heat.of(tokens)[order], begin)
            return sign[np.lexsort((sign, -size, cost))[: limit + 1]]
        out = [sign]
        group = np.repeat(np.arange(len(begin)), size)
        many = size[group] > 1
        fewer = (total[group] - content)[many]
        out.append(textvec.mix(fewer ^ textvec.mix(place[group][many] + ((size[group][many] - 1).astype(np.uint64) << np.uint64(44)))))
        if np.minimum(size, 2).sum() <= limit:
            out.append(textvec.mix(content ^ np.uint64(0x2545F4914F6CDD1D)))
    return np.concatenate(out)


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    for first, _, data, starts in textvec.blocks(texts):
        yield first, token_sets(data, starts)


def nodes(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, node, parity, wide of every document; and heavy tokens of a stretch (hot, hot_counts)."""
    ship_code(docs.sparkSession)

    def run(batches):
        held, size, seen = [], 0, set()

        def heavy():
            if not held:
                return None, None
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            keep = counts >= max(8, size >> HOT_BITS)
            return tokens[keep].view(np.int64).tolist(), counts[keep].tolist()

        def record(ids, text_hash, n, node, parity, wide, hot, counts):
            pad = [None] * (len(ids) - 1)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(text_hash, pa.int64()), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(parity, pa.binary()), pa.array(wide, pa.binary()),
                 pa.array([hot, *pad], pa.list_(pa.int64())), pa.array([counts, *pad], pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "n_shingles", "node", "parity", "wide", "hot", "hot_counts"],
            )

        for batch in batches:
            ids, hashes = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
            for first, sets in _sets(batch):
                own = [node_of(t) for t in sets]
                for node, t in zip(own, sets):
                    if node not in seen and len(t):
                        seen.add(node)
                        held.append(t)
                        size += len(t)
                hot = counts = None
                if size > HOT_TOKENS:
                    hot, counts = heavy()
                    held, size, seen = [], 0, set()
                yield record(ids[first : first + len(sets)], hashes[first : first + len(sets)], [len(t) for t in sets], own, [parities(t) for t in sets], [wide_parities(t) for t in sets], hot, counts)
        if held:
            yield record(*[[None]] * 6, *heavy())

    schema = "doc_id long, text_hash long, n_shingles long, node long, parity binary, wide binary, hot array<long>, hot_counts array<long>"
    text = text_of("text")
    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(run, schema)


def heat_of(rows: DataFrame) -> Heat:
    """The heavy tokens: those in at least one of 2**HOT_BITS of all tokens, so at most 2**HOT_BITS."""
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    pairs = rows.where("hot is not null").select(F.explode(F.arrays_zip("hot", "hot_counts")).alias("t"))
    sums = pairs.groupBy("t.hot").agg(F.sum("t.hot_counts").alias("n")).where(F.col("n") >= max(HOT_LEAST, total >> HOT_BITS))
    table = sums.toArrow()
    return Heat(table["hot"].to_numpy().view(np.uint64), table["n"].to_numpy())


def indexed(docs: DataFrame, heat: Heat) -> DataFrame:
    """(sign, node): the index. A task indexes equal sets once."""
    ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((heat.tokens, heat.counts))

    def run(batches):
        own = Heat(*shared.value)
        seen: set[int] = set()
        for batch in batches:
            for _, sets in _sets(batch):
                signs, owners = [], []
                for t in sets:
                    if len(t) < 4:
                        continue
                    node = node_of(t)
                    if node in seen:
                        continue
                    if len(seen) > SEEN_NODES:
                        seen.clear()
                    seen.add(node)
                    for s in signatures(t, own):
                        signs.append(s)
                        owners.append(np.full(len(s), node, np.int64))
                if signs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(signs).view(np.int64)), pa.array(np.concatenate(owners))], names=["sign", "node"]
                    )

    rows = docs.where("doc_id is not null").select(text_of("text").alias("text"))
    return rows.mapInArrow(run, "sign long, node long")


def groups(index: DataFrame) -> DataFrame:
    """(sign, node, place) of all signatures that several nodes share; places count a group's nodes from 0.

    A pass over sorted rows that keeps one row back: a group may be of any size.
    """

    def run(batches):
        sign = last = None
        seen = 0  # nodes of the running group; a first one alone isn't yielded yet
        for batch in batches:
            s, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(s):
                continue
            keep = np.ones(len(s), bool)
            keep[1:] = (s[1:] != s[:-1]) | (n[1:] != n[:-1])
            if sign is not None:
                keep[0] = s[0] != sign or n[0] != last
            s, n = s[keep], n[keep]
            if not len(s):
                continue
            if seen == 1:
                s, n, seen = np.concatenate(([sign], s)), np.concatenate(([last], n)), 0
            begin = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
            size = np.diff(np.append(begin, len(s)))
            place = np.arange(len(s)) - np.repeat(begin, size)
            before = seen if seen and s[0] == sign else 0
            place[: size[0]] += before
            shared = size > 1
            shared[0] |= before > 0
            sign, last, seen = s[-1], n[-1], int(place[-1]) + 1
            out = np.repeat(shared, size)
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(s[out]), pa.array(n[out]), pa.array(place[out])], names=["sign", "node", "place"])

    return index.repartition("sign").sortWithinPartitions("sign", "node").mapInArrow(run, "sign long, node long, place long")


def word_shingles(text: str) -> set[bytes]:
    """The shingles themselves, for verification."""
    words = bytes(text.encode("utf-8", "surrogatepass").lower()).split()
    if len(words) < WORDS:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i : i + WORDS]) for i in range(len(words) - WORDS + 1)}


def verified(pairs: DataFrame, known: DataFrame, docs: DataFrame) -> DataFrame:
    """(hub, node, linked) of pairs (hub, node), decided on the words of one document of each node.

    Members are dealt to (hub, chunk) with a copy of the hub's text, so a hub with many members is
    many tasks' work.
    """
    ship_code(docs.sparkSession)
    sizes = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    members = pairs.join(sizes, "hub").select("hub", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk"), "node", F.lit(1).alias("role"))
    heads = sizes.select("hub", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.col("hub").alias("node"), F.lit(0).alias("role"))
    roles = members.unionByName(heads).join(known.select("node", "rep"), "node")
    texts = docs.select(F.col("doc_id").alias("rep"), text_of("text").alias("text"))
    asked = saved(roles.select("rep").distinct(), "jaccard-asked")
    if asked.count() <= SENT_IDS:
        texts = texts.join(F.broadcast(asked), "rep", "left_semi")
    rows = roles.join(texts, "rep").select("hub", "chunk", "role", "node", "text")

    def run(batches):
        current, head = None, None
        for batch in batches:
            hubs, chunks, role, nodes_, texts_ = (batch.column(i) for i in range(5))
            out = []
            for hub, chunk, r, node, text in zip(hubs.to_pylist(), chunks.to_pylist(), role.to_pylist(), nodes_.to_pylist(), texts_):
                text = text.as_py()
                raw = text.encode("utf-8", "surrogatepass")
                if node_of(token_sets(np.frombuffer(raw + b"\n", np.uint8), np.zeros(1, np.int64))[0]) != node:
                    continue  # another text under the same doc_id
                shingles = word_shingles(text)
                if r == 0:
                    current, head = (hub, chunk), shingles
                elif current == (hub, chunk):
                    common = len(head & shingles)
                    out.append((hub, node, 100 * common >= 80 * (len(head) + len(shingles) - common)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.bool_())],
                names=["hub", "node", "linked"],
            )

    dealt = rows.repartition("hub", "chunk").sortWithinPartitions("hub", "chunk", "role", "node")
    return dealt.mapInArrow(run, "hub long, node long, linked boolean").groupBy("hub", "node").agg(F.max("linked").alias("linked"))


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of all nodes of edges (hub, node): the least node reachable.

    Labels spread to neighbours and then jump to their own label's label, so a chain of n nodes
    takes about log n rounds. Every round is written to the shared folder.
    """
    both = saved(edges.select(F.col("hub").alias("a"), F.col("node").alias("b")).unionByName(
        edges.select(F.col("node").alias("a"), F.col("hub").alias("b"))).distinct(), "jaccard-edges")
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("comp")), "jaccard-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        spread = labels.join(near, "node").select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("comp").alias("far"))
        moved = saved(spread.join(jump, "next", "left").select("node", "was", F.least("next", F.coalesce("far", "next")).alias("comp")), "jaccard-labels")
        discard(labels)
        labels = moved
        if moved.where("was <> comp").isEmpty():
            discard(both)
            return labels.select("node", "comp")


def _open(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """(sign, node, comp) of the groups whose nodes aren't all in one component."""
    rows = shared.join(labels, "node", "left").select("sign", "node", "place", F.coalesce("comp", "node").alias("comp"))
    mixed = rows.groupBy("sign").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("sign")
    return rows.join(mixed, "sign")


class Members:
    """Rows of groups, sorted: what a task compares."""

    def __init__(self, table: pa.Table):
        column = lambda name: table.column(name).combine_chunks()
        self.sign, self.cell, self.role, self.node, self.comp, self.size, self.block = (
            column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("sign", "cell", "role", "node", "comp", "n_shingles", "block"))
        held = column("parity")
        self.bits = np.frombuffer(b"".join(held.to_pylist()), np.uint64).reshape(len(held), -1)
        self.wide = column("wide")

    def possible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of rows (a, b) sizes and parities don't rule out."""
        lo, hi = np.minimum(self.size[a], self.size[b]), np.maximum(self.size[a], self.size[b])
        out = 100 * lo >= 80 * hi
        at = np.flatnonzero(out)
        x, y = (v if v.ndim == 0 else v[at] for v in (np.asarray(a), np.asarray(b)))
        apart, most = np.bitwise_count(self.bits[x] ^ self.bits[y]).sum(-1), (lo[at] + hi[at]) // 9
        out[at] = apart <= most
        for k in np.flatnonzero(out & (lo > PARITY_BITS // 2)):
            p, q = (self.wide[int(v if np.ndim(v) == 0 else v[k])].as_py() for v in (a, b))
            out[k] = p is None or q is None or least_difference(p, q) <= (lo[k] + hi[k]) // 9
        return out

    def proposals(self, quota: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows (a, b) of the proposed pairs."""
        begin = np.flatnonzero(np.concatenate(([True], (self.sign[1:] != self.sign[:-1]) | (self.cell[1:] != self.cell[:-1]))))
        size = np.diff(np.append(begin, len(self.sign)))
        plain = (size <= SMALL) & ~np.logical_or.reduceat(self.role != 0, begin)
        found = []
        for n in range(2, SMALL + 1):
            first = begin[plain & (size == n)]
            for i in range(n - 1) if len(first) else ():
                for j in range(i + 1, n):
                    a, b = first + i, first + j
                    open_ = self.comp[a] != self.comp[b]
                    a, b = a[open_], b[open_]
                    ok = self.possible(a, b)
                    found.append((a[ok], b[ok]))
        for at, n in zip(begin[~plain], size[~plain]):
            found += self._large(int(at), int(at + n), quota)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found))

    def _large(self, at: int, to: int, quota: int) -> list[tuple]:
        # Pairs that were verified and aren't linked come first, then the nodes.
        apart: dict[int, list[int]] = {}
        while at < to and self.role[at] == -1:
            apart.setdefault(self.node[at], []).append(self.comp[at])
            apart.setdefault(self.comp[at], []).append(self.node[at])
            at += 1
        node, block = self.node[at:to], self.block[at:to]
        label = np.unique(self.comp[at:to], return_inverse=True)[1]
        crossed = at < to and self.role[at] == 1
        agreed: dict[tuple, int] = {}
        out = []
        for i in range(to - at - 1):
            far = label[i + 1 :] != label[i]
            if crossed:
                far &= block[i + 1 :] != block[i]
            far = np.flatnonzero(far) + i + 1
            if not len(far):
                continue
            far = far[self.possible(np.asarray(at + i), at + far)]
            if node[i] in apart:
                far = far[~np.isin(node[far], apart[node[i]])]
            if not len(far):
                continue
            far = far[np.argsort(label[far], kind="stable")]
            begin = np.flatnonzero(np.concatenate(([True], label[far][1:] != label[far][:-1])))
            runs = np.diff(np.append(begin, len(far)))
            taken = far[np.arange(len(far)) - np.repeat(begin, runs) < quota]
            out.append((np.full(len(taken), at + i), at + taken))
            for other, n in zip(label[far][begin].tolist(), runs.tolist()):
                own = int(label[i])
                pair = (min(own, other), max(own, other))
                agreed[pair] = agreed.get(pair, 0) + min(n, quota)
                if agreed[pair] >= quota:
                    label[label == other] = own
        return out


def _cells(rows: DataFrame, hot: DataFrame, across: bool) -> DataFrame:
    """rows with cell, role and block: which tasks of its group a node goes to. Role 1 marks tasks of two blocks."""
    block = F.floor(F.col("place") / BLOCK)
    own = rows.join(hot, "sign", "left").withColumns({"block": block, "blocks": F.coalesce("blocks", F.lit(1).cast("long"))})
    if not across:
        return own.withColumns({"cell": F.col("block"), "role": F.lit(0)}).drop("blocks", "place")
    all_ = own.withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cell = F.least("block", "to") * F.col("blocks") + F.greatest("block", "to")
    return all_.withColumns({"cell": cell, "role": (F.col("block") != F.col("to")).cast("int")}).drop("blocks", "place", "to")


def _apart_in_cells(apart: DataFrame, rows: DataFrame, hot: DataFrame) -> DataFrame:
    """(sign, cell, hub, node): the one task of its group that holds both nodes of a pair (sign, hub, node)."""
    spot = rows.select("sign", "node", F.floor(F.col("place") / BLOCK).alias("block"))
    first = apart.join(spot.select("sign", F.col("node").alias("hub"), F.col("block").alias("other")), ["sign", "hub"])
    both = first.join(spot, ["sign", "node"]).join(hot, "sign", "left")
    cell = F.least("block", "other") * F.coalesce("blocks", F.lit(1).cast("long")) + F.greatest("block", "other")
    return both.select("sign", cell.alias("cell"), "hub", "node")


def proposed(rows: DataFrame, known: DataFrame, hot: DataFrame, apart: DataFrame | None, quota: int) -> DataFrame:
    """(sign, hub, node): pairs of different components to verify, of rows (sign, node, place, comp).

    apart, from the second round on, is (sign, hub, node): what a group proposed and isn't linked.
    """
    ship_code(rows.sparkSession)
    celled = _cells(rows, hot, apart is not None)
    full = celled.join(known.select("node", "n_shingles", "parity", "wide"), "node")
    columns = ["sign", "cell", "role", "node", "comp", "n_shingles", "block", "parity", "wide"]
    full = full.select(columns)
    if apart is not None:
        both = _apart_in_cells(apart, rows, hot)
        nothing = F.lit(bytes(PARITY_BITS // 8))
        full = full.unionByName(both.select(
            "sign", "cell", F.lit(-1).alias("role"), F.col("hub").alias("node"), F.col("node").alias("comp"), F.lit(0).cast("long").alias("n_shingles"),
            F.lit(0).cast("long").alias("block"), nothing.alias("parity"), F.lit(None).cast("binary").alias("wide")))

    def found(table):
        members = Members(table)
        a, b = members.proposals(quota)
        x, y = members.node[a], members.node[b]
        return pa.RecordBatch.from_arrays([pa.array(members.sign[a]), pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["sign", "hub", "node"])

    def run(batches):
        held, rows_held = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            s, c = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero((s[1:] != s[:-1]) | (c[1:] != c[:-1])) + 1
            new = not held or held[-1].column(0)[-1].as_py() != s[0] or held[-1].column(1)[-1].as_py() != c[0]
            cut = int(edges[-1]) if len(edges) else 0  # the batch's last group starts here
            if (cut or new) and rows_held + cut:
                yield found(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held, rows_held = [], 0
            held.append(batch.slice(cut))
            rows_held += batch.num_rows - cut
        if held:
            yield found(pa.Table.from_batches(held))

    dealt = full.repartition("sign", "cell").sortWithinPartitions("sign", "cell", "role", "node")
    return dealt.mapInArrow(run, "sign long, hub long, node long")


def linked_components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, labels): rows is doc_id, text_hash, n_shingles, node of each document; labels (node, comp) of linked nodes."""
    everything = saved(nodes(docs), "jaccard-nodes")
    rows = everything.where("node is not null").select("doc_id", "text_hash", "n_shingles", "node", "parity", "wide")
    known = saved(
        rows.where("doc_id is not null and n_shingles > 3").groupBy("node")
        .agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"), F.max("parity").alias("parity"), F.max("wide").alias("wide")), "jaccard-known",
    )
    shared = saved(groups(indexed(docs, heat_of(everything))), "jaccard-groups")
    hot = saved(shared.where(F.col("place") >= BLOCK).groupBy("sign").agg((F.floor(F.max("place") / BLOCK) + 1).alias("blocks")), "jaccard-hot")
    open_, tested, labels, quota, apart = shared.withColumn("comp", F.col("node")), None, None, 1, None
    while True:
        found = saved(proposed(open_, known, hot, apart, quota), "jaccard-proposed")
        if tested is not None and found.isEmpty():
            break
        pairs = found.select("hub", "node").distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["hub", "node"], "left_anti")  # another group may have proposed it before
        fresh = verified(saved(pairs, "jaccard-pairs"), known, docs)
        active = found.select("sign")
        if tested is None:
            active = active.unionByName(hot.select("sign"))
        else:
            fresh = fresh.unionByName(tested)
        tested = saved(fresh, "jaccard-tested")
        failed = found.join(tested.where("not linked"), ["hub", "node"], "left_semi").select("sign", "hub", "node")
        apart = saved(failed if apart is None else failed.unionByName(apart), "jaccard-apart")
        labels = components(tested.where("linked"))
        open_ = saved(_open(shared.join(active.distinct(), "sign", "left_semi"), labels), "jaccard-open")
        if open_.isEmpty():
            break
        quota = quota * QUOTA
    return rows.select("doc_id", "text_hash", "n_shingles", "node"), labels


def join(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Null and empty texts and texts of white space have no shingles and link with nothing (each is its
    own component), shorter ones than five words are one shingle. Rows that repeat a doc_id are rows of their own. A null
    doc_id takes no part in links: its component_id is null. An empty table gives an empty result.
    """
    rows, labels = linked_components(docs)
    placed = rows.join(labels, "node", "left").select("doc_id", "n_shingles", "node", F.coalesce("comp", "node").alias("comp"))
    named = placed.where("doc_id is not null and n_shingles > 0").groupBy("node", "comp").agg(F.min("doc_id").alias("least"))
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    ids = named.join(least, "comp").select("node", "component_id")
    out = rows.join(ids, "node", "left")
    own = F.when(F.col("doc_id").isNull() | (F.col("n_shingles") == 0), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"))


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with their own columns: of each component the one with the smallest
    doc_id (if several texts have it, that with the least hash). Rows that repeat its doc_id and text
    stay with it. Rows without words or without a doc_id all stay.
    """
    rows, labels = linked_components(docs)
    placed = rows.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    first = placed.where(~alone).groupBy("comp").agg(F.min(F.struct("doc_id", "text_hash")).alias("s")).select("s.doc_id", "s.text_hash")
    stay = first.unionByName(placed.where(alone).select("doc_id", "text_hash").distinct()).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    marked = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"), "doc_id", F.xxhash64(text_of("text")).alias("__own"))
    return marked.join(stay, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__hash"))).select("__row.*")

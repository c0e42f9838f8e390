"""Exact n-gram Jaccard self-join by groups of similar documents and their token unions.

A document's set holds its distinct word shingles; two documents link at a similarity of ``PERCENT`` or more.

* Equal sets are one node from the start, so copies cost one row per map task.
* Grouping. Sets are divided into parts by token hash, more parts than a linking pair can differ in, so that such a
  pair agrees in a whole part. Parts are made of a set's rarer tokens as far as these suffice, so that a passage
  shared by many documents groups none of them. Nodes with an equal part form a group; its most central node is the
  pivot.
* Nodes are compared with their pivots. Linked nodes become components: the similar documents of a group.
* Token-group matrix. Of groups that still hold several components, nodes of which most tokens are in their own
  component alone link with no other. The rest ask the components that have one of their leading tokens, the rarest
  of these groups. An asked component gets a matrix row: the greatest count of its members' tokens in each of some
  hash buckets, a bounded form of their token union. A node's overlap with any member is at most the sum of the
  smaller counts; only components where that is enough for a link are opened, and the node is compared with the
  members it shares a leading token with. Nothing is compared twice, nothing is capped.

Comparisons run in salted portions of a pivot's nodes, against one set held at a time.

NULL text, or a text without words, has an empty set (size 0) and links with nothing. Repeated rows each get a row.
A NULL id has the component of its links; a component of NULL ids only is NULL. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railyard.llm import arrays, tables
from railyard.llm.components import components

WIDTH = 5
PERCENT = 80
PORTION = 256
SEEN = 500_000
SLOTS = 1 << 20
SLICES = 64
LAST = 2
SOME = 3


def size_bounds() -> np.ndarray:
    """First size of each size class; classes grow by half."""
    bounds = [1, 2, 3, 4, 5, 6, 8, 10]
    while bounds[-1] < 1 << 40:
        bounds.append(bounds[-1] * 3 // 2)
    return np.array(bounds, np.int64)


class Sets:
    """Distinct shingles of some texts: ``tokens`` sorted within each text, which ``owner`` names."""

    def __init__(self, texts: arrays.Texts, width: int):
        words = texts.words(arrays.PLAIN)
        value, owner = arrays.shingles(words, words.hashes(), width)
        bits = np.uint64(int(texts.count).bit_length())
        order = np.argsort((owner.astype(np.uint64) << (np.uint64(64) - bits)) | (value >> bits), kind="stable")
        value, owner = value[order], owner[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        self.tokens, self.owner = value[new], owner[new]
        self.size = np.bincount(self.owner, minlength=texts.count).astype(np.int64)
        self.ends = np.cumsum(self.size)
        self.count = texts.count
        self.mark, self.mark2 = (self._sums(arrays.mix(self.tokens ^ np.uint64(salt))) for salt in (0x1234567, 0x89ABCDEF))

    def _sums(self, value: np.ndarray) -> np.ndarray:
        out = np.zeros(self.count, np.uint64)
        full = np.flatnonzero(self.size)
        if len(full):
            out[full] = np.add.reduceat(value, (self.ends - self.size)[full])
        return arrays.mix(out + self.size.astype(np.uint64))

    def of(self, k: int) -> np.ndarray:
        return self.tokens[self.ends[k] - self.size[k] : self.ends[k]]


def signatures(sets: Sets, chosen: np.ndarray, percent: int, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the parts of the chosen texts, and their texts.

    A pair in a class of sizes up to N differs in at most 2 N (100 - percent) / (100 + percent) tokens, and in as
    many parts at most. With more parts than that, some part is equal. A part empty on both sides does not count:
    spare parts make up for these. This also holds for the tokens outside ``common`` alone, so parts are made of
    these. A text for which they do not suffice adds smaller parts of these, then the parts of all its tokens: of two
    texts, both give the parts that suffice for either.
    """
    bounds = size_bounds()
    own = np.searchsorted(bounds, sets.size, "right") - 1
    top = np.searchsorted(bounds, sets.size * 100 // percent, "right") - 1
    rare = ~common[slot_of(sets.tokens, len(common))]
    mixed = arrays.mix(sets.tokens ^ np.uint64(0x5BD1E995))
    pieces = [(mixed >> np.uint64(k * 21) & np.uint64(0x1FFFFF)).astype(float) for k in range(3)]
    found, texts = [], []

    def give(kind: np.ndarray, use: np.ndarray, tokens: np.ndarray, differ: np.ndarray, spare: int, scheme: int) -> np.ndarray:
        """Adds one scheme's signatures; returns whether a text has an equal part that is not empty in any link."""
        parts = np.where(use, np.where(differ == 0, 1, differ + 1 + (differ + 1) * spare // 100 + 2), 0)
        base = np.cumsum(parts) - parts
        total = int(parts.sum())
        mine = use[sets.owner] & tokens
        owner = sets.owner[mine]
        slot = base[owner] + ((sets.tokens[mine] >> np.uint64(24)) % parts[owner].astype(np.uint64)).astype(np.int64)
        counts = np.bincount(slot, minlength=total)
        sums = [np.bincount(slot, weights=w[mine], minlength=total).astype(np.uint64) for w in pieces]
        value = sums[0] + (sums[1] << np.uint64(21)) + (sums[2] << np.uint64(42))
        text = np.repeat(np.arange(sets.count), parts)
        part = np.arange(total) - base[text]
        empty = np.bincount(text, weights=counts == 0, minlength=sets.count)
        enough = empty < parts - differ
        # too many empty parts: in the last scheme, these are given too
        keep = (counts > 0) | (~enough[text] if scheme == LAST else np.zeros(total, bool))
        tag = (kind[text] * 1_000_003 + part).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (counts * 3 + scheme).astype(np.uint64)
        found.append(arrays.mix(value + arrays.mix(tag))[keep])
        texts.append(text[keep])
        return enough

    for up in range(3):
        kind = own + up
        use = chosen & (kind <= top) & (sets.size > 0)
        if not use.any():
            continue
        largest = bounds[np.minimum(kind, len(bounds) - 2) + 1] - 1
        differ = 2 * largest * (100 - percent) // (100 + percent)
        for scheme, (tokens, spare) in enumerate(((rare, 30), (rare, 300), (np.ones(len(rare), bool), 15))):
            if use.any():
                use = use & ~give(kind, use, tokens, differ, spare, scheme)
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(texts)


def slot_of(tokens: np.ndarray, size: int) -> np.ndarray:
    return (tokens >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


def common_tokens(docs: DataFrame, width: int) -> np.ndarray:
    """Marks the slots of ``SLOTS`` token hashes that stand out by their number of documents, over all documents.

    A fixed size, whatever the corpus; it only decides how many candidates there are, never which links are found.
    """
    cut = SLOTS // SLICES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for texts in arrays.chunks(batch.column(0)):
                counts += np.bincount(slot_of(Sets(texts, width).tokens, SLOTS), minlength=SLOTS)
        blobs = [counts[k * cut : (k + 1) * cut].astype(np.uint32).tobytes() for k in range(SLICES)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(blobs, pa.binary())], names=["slice", "blob"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums[k] = sums.get(k, 0) + np.frombuffer(blob.as_buffer(), np.uint32).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["slice", "blob"])

    schema = "slice int, blob binary"
    counts = np.zeros(SLOTS, np.int64)
    for r in docs.select("text").mapInArrow(run, schema).repartition("slice").mapInArrow(add, schema).collect():  # SLICES rows of a fixed size
        counts[r["slice"] * cut : (r["slice"] + 1) * cut] = np.frombuffer(r["blob"], np.int64)
    usual = float(np.median(counts))
    return counts > usual + 6 * max(1.0, usual) ** 0.5 + 6


def sized(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, t, n, mark, mark2) per row: text hash, set size and 128-bit set digest; and the row's number, if any."""
    number = [tables.ROW] if tables.ROW in docs.columns else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in arrays.chunks(batch.column(2)):
                sets = Sets(texts, width)
                here = slice(texts.first, texts.first + texts.count)
                made = [batch.column(0)[here], batch.column(1)[here], pa.array(sets.size), arrays.as_long(sets.mark), arrays.as_long(sets.mark2)]
                made += [batch.column(3 + k)[here] for k in range(len(number))]
                yield pa.RecordBatch.from_arrays(made, names=["doc_id", "t", "n", "mark", "mark2", *number])

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, t long, n long, mark long, mark2 long" + "".join(f", {c} long" for c in number)
    return docs.select("doc_id", "t", "text", *number).mapInArrow(run, schema)


def parts(docs: DataFrame, width: int, percent: int, bits: int, common: np.ndarray) -> DataFrame:
    """(sig, node): part signatures of ``bits`` bits; a task gives a set's parts once, as far as it remembers the sets
    it has seen."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for texts in arrays.chunks(batch.column(0)):
                sets = Sets(texts, width)
                if len(seen) > SEEN:
                    seen.clear()
                chosen = np.zeros(texts.count, bool)
                for k, mark in enumerate(sets.mark.tolist()):
                    if mark not in seen:
                        seen.add(mark)
                        chosen[k] = True
                sig, text = signatures(sets, chosen, percent, shared.value)
                yield pa.RecordBatch.from_arrays([arrays.as_long(sig >> np.uint64(64 - bits)), arrays.as_long(sets.mark[text])], names=["sig", "node"])

    return docs.select("text").mapInArrow(run, "sig long, node long")


def grouped(signed: DataFrame) -> DataFrame:
    """(sig, pivot, node) for groups of two nodes or more; rows of a signature stream by, none is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_sig = last_node = pivot = None
        for batch in batches:
            sig, node = (batch.column(k).to_numpy() for k in (0, 1))
            if not len(sig):
                continue
            new = np.ones(len(sig), bool)
            new[1:] = sig[1:] != sig[:-1]
            if last_sig is not None and sig[0] == last_sig:
                new[0] = False
            again = np.zeros(len(sig), bool)
            again[1:] = (node[1:] == node[:-1]) & ~new[1:]
            again[0] = not new[0] and node[0] == last_node
            head = np.maximum.accumulate(np.where(new, np.arange(len(sig)), -1))
            pivots = np.where(head >= 0, node[np.maximum(head, 0)], 0 if pivot is None else pivot)
            last_sig, last_node, pivot = sig[-1], node[-1], pivots[-1]
            give = ~new & ~again
            yield pa.RecordBatch.from_arrays([pa.array(sig[give]), pa.array(pivots[give]), pa.array(node[give])], names=["sig", "pivot", "node"])

    dealt = signed.repartition("sig").sortWithinPartitions("sig", "node")
    return dealt.mapInArrow(run, "sig long, pivot long, node long")


def centered(groups: DataFrame) -> DataFrame:
    """(sig, pivot, node) with the most central node of each group as its pivot.

    Central is what shares its parts with most others, summed over all its groups: the original of many edited
    copies rather than one of the copies, which may each be too far from the others to link.
    """
    members = groups.select("sig", "node").union(groups.select("sig", F.col("pivot").alias("node")).distinct())
    sizes = groups.groupBy("sig").agg((F.count("*") + 1).alias("size"))
    weights = members.join(sizes, "sig").groupBy("node").agg(F.sum("size").alias("weight"))
    weighted = tables.written(members.join(weights, "node"), "weighted")
    pivots = weighted.groupBy("sig").agg(F.max_by("node", F.struct("weight", "node")).alias("pivot"))
    return weighted.join(pivots, "sig").filter("node <> pivot").select("sig", "pivot", "node")


def portioned(pairs: DataFrame) -> DataFrame:
    """(a, portion, part, mark): what is to be compared, in portions of an ``a``'s partners; part 0 is ``a`` itself."""
    portions = pairs.groupBy("a").agg(F.ceil(F.count("*") / PORTION).cast("int").alias("portions"))
    members = pairs.join(portions, "a").select("a", F.pmod(F.xxhash64("b"), F.col("portions")).cast("int").alias("portion"), F.lit(1).alias("part"), F.col("b").alias("mark"))
    heads = portions.select("a", F.explode(F.sequence(F.lit(0), F.col("portions") - 1)).alias("portion"), F.lit(0).alias("part"), F.col("a").alias("mark"))
    return members.union(heads)


def first_texts(shared: DataFrame, best: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The texts of all grouped nodes, laid out for the first comparison; ``main`` marks one row of each node.

    The documents are shuffled once, here. Nodes without a pivot to compare with have part 2.
    """
    pairs = tables.written(best.select(F.col("pivot").alias("a"), F.col("node").alias("b")), "best")
    laid = portioned(pairs)
    nodes = shared.select("node").union(shared.select(F.col("pivot").alias("node"))).distinct()
    others = nodes.join(laid.select(F.col("mark").alias("node")).distinct(), "node", "left_anti")
    laid = laid.union(others.select(F.col("node").alias("a"), F.lit(0).alias("portion"), F.lit(2).alias("part"), F.col("node").alias("mark")))
    second = pairs.select(F.col("b").alias("mark"), F.lit(True).alias("second"))
    laid = laid.join(second, "mark", "left").withColumn("main", (F.col("part") != 0) | (F.col("second").isNull() & (F.col("portion") == 0)))
    wanted = laid.join(classes.select("mark", "rep"), "mark")
    wanted = wanted.select("a", "portion", "part", "mark", "main", F.col("rep.doc_id").alias("rep_id"), F.col("rep.t").alias("rep_t"))
    rows = docs.join(wanted, (docs["t"] == wanted["rep_t"]) & docs["doc_id"].eqNullSafe(wanted["rep_id"]))
    return tables.written(rows.select("a", "portion", "part", "mark", "main", "text"), "texts")


def compared(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b) that link, of (a, portion, part, mark, text); decided on the sets themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, heads = None, []
        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(4))))
            found: list[tuple[int, int]] = []
            for texts in arrays.chunks(batch.column(4)):
                sets = Sets(texts, width)
                marks = arrays.as_long(sets.mark).to_pylist()
                for k in range(texts.count):
                    a, portion, part, mark = keys[texts.first + k]
                    if marks[k] != mark:  # another row with the same id and text hash
                        continue
                    if (a, portion) != at:
                        at, heads = (a, portion), []
                    mine = sets.of(k)
                    if part == 0:
                        if not any(np.array_equal(mine, h) for h in heads):
                            heads.append(mine.copy())
                    else:
                        for head in heads:
                            both = len(np.intersect1d(head, mine, assume_unique=True))
                            if 100 * both >= percent * (len(head) + len(mine) - both):
                                found.append((a, mark))
                                break
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    dealt = rows.select("a", "portion", "part", "mark", "text").repartition("a", "portion").sortWithinPartitions("a", "portion", "part")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def bucket_counts(tokens: np.ndarray) -> np.ndarray:
    """How many tokens fall into each bucket of a hash; buckets are a power of two, about half as many as tokens."""
    buckets = 1 << min(13, max(3, (len(tokens) // 2).bit_length()))
    return np.minimum(np.bincount((tokens & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets), 65535).astype(np.uint16)


def folded(x: np.ndarray, buckets: int) -> np.ndarray:
    """The same with fewer buckets."""
    return np.minimum(x.reshape(-1, buckets).sum(0, dtype=np.int64), 65535).astype(np.uint16)


def overlap_bound(x: np.ndarray, y: np.ndarray) -> int:
    """At least as many as the tokens two sets can share; a full bucket counts as any number."""
    buckets = min(len(x), len(y))
    x, y = folded(x, buckets).astype(np.int64), folded(y, buckets).astype(np.int64)
    return 1 << 60 if ((x == 65535) & (y == 65535)).any() else int(np.minimum(x, y).sum())


def profiles(texts: DataFrame, width: int) -> DataFrame:
    """(node, profile): bucket counts of each node's tokens, about a byte a token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.chunks(batch.column(1)):
                sets = Sets(part, width)
                made = [bucket_counts(sets.of(k)).tobytes() for k in range(part.count)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[part.first : part.first + part.count], pa.array(made, pa.binary())], names=["node", "profile"])

    return texts.select("mark", "text").mapInArrow(run, "node long, profile binary")


def unions(members: DataFrame) -> DataFrame:
    """(group, matrix) of (group, profile): the greatest count of each bucket. Tasks combine theirs first."""

    def merged(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        buckets = min(len(x), len(y))
        return np.maximum(folded(x, buckets), folded(y, buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def given() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([x.tobytes() for x in held.values()], pa.binary())], names=["group", "profile"])
            held.clear()
            return made

        for batch in batches:
            for group, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.frombuffer(value, np.uint16)
                held[group] = merged(held[group], counts) if group in held else counts
            if len(held) > 20_000:  # rows come sorted, so only the last group can go on
                last = held.pop(group)
                yield given()
                held[group] = last
        yield given()

    schema = "group long, profile binary"
    combined = members.select("group", "profile").sortWithinPartitions("group").mapInArrow(run, schema)
    return combined.repartition("group").sortWithinPartitions("group").mapInArrow(run, schema).withColumnRenamed("profile", "matrix")


def possible(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """``keys`` of the rows (keys, n, low, profile, matrix) whose overlap bound lets a set of size ``n`` link with one
    of size ``low`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, low = batch.column(len(keys)).to_pylist(), batch.column(len(keys) + 1).to_pylist()
            good = []
            for k in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(len(keys) + c)[k].as_buffer(), np.uint16) for c in (2, 3))
                least = max(low[k], -(-n[k] * percent // 100))
                good.append(overlap_bound(x, y) * (100 + percent) >= percent * (n[k] + least))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(good, pa.bool_())) for k in range(len(keys))], names=keys)

    return rows.select(*keys, "n", "low", "profile", "matrix").mapInArrow(run, ", ".join(f"{k} long" for k in keys))


def plausible(pairs: DataFrame, sizes: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """(a, b) whose profiles let them link."""
    a = sizes.join(known, "node").select(F.col("node").alias("a"), "n", "profile")
    b = sizes.join(known, "node").select(F.col("node").alias("b"), F.col("n").alias("low"), F.col("profile").alias("matrix"))
    return possible(pairs.select("a", "b").join(a, "a").join(b, "b"), ["a", "b"], percent)


def tokens_of(texts: DataFrame, width: int, every: int = 1) -> DataFrame:
    """(token, node, root) for each token of the nodes' sets, of (mark, root, text); or for the tokens of one in
    ``every`` hashes, the same ones in all sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mark, root = (batch.column(k).to_numpy() for k in (0, 1))
            for part in arrays.chunks(batch.column(2)):
                sets = Sets(part, width)
                here = slice(part.first, part.first + part.count)
                # another row with the same id and text hash is left out
                mine = (sets.mark.view(np.int64) == mark[here])[sets.owner] & (arrays.mix(sets.tokens) % np.uint64(every) == 0)
                owner = sets.owner[mine]
                yield pa.RecordBatch.from_arrays([arrays.as_long(sets.tokens[mine]), pa.array(mark[here][owner]), pa.array(root[here][owner])], names=["token", "node", "root"])

    return texts.select("mark", "root", "text").mapInArrow(run, "token long, node long, root long")


def spread(tokens: DataFrame) -> DataFrame:
    """(token, node, root, nodes, low, high): the number of nodes that have the token, and two of their components if
    there are several. One shuffle, by token."""
    same = Window.partitionBy("token")
    return tokens.select("token", "node", "root", F.count("*").over(same).alias("nodes"), F.min("root").over(same).alias("low"), F.max("root").over(same).alias("high"))


def fewest(percent: int) -> Column:
    """How many of its ``n`` tokens a node shares with any it links with, at least."""
    return F.ceil(F.col("n") * percent / 100)


def alone(tokens: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(node) that links with no other component: too many of its tokens, even of those given, are in no other."""
    own = spread(tokens).filter("low = high").select("token", "node").distinct().groupBy("node").agg(F.count("*").alias("own"))
    return own.join(sizes, "node").filter(F.col("n") - F.col("own") < fewest(percent)).select("node")


def leading(tokens: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(token, node, root, n, place): the tokens of a node one of which it shares with any node of another component
    that it links with.

    A node links only where it shares ``fewest`` of its tokens, so of these, in one order for all nodes, the first
    ``n - fewest + 1`` hold a shared one, and likewise those of the other node. Tokens that no other component has come
    first and are not given. The others follow by their number of nodes, so that the text a large group has in common
    comes last.
    """
    shared = spread(tokens).filter("low <> high").dropDuplicates(["token", "node"]).join(sizes, "node")
    mine = Window.partitionBy("node")
    placed = shared.select(
        "token", "node", "root", "n", F.count("*").over(mine).alias("shared"), F.row_number().over(mine.orderBy("nodes", "token")).alias("rank")
    )
    placed = placed.filter(F.col("rank") <= F.col("shared") - fewest(percent) + 1)
    return placed.select("token", "node", "root", "n", (F.col("n") - F.col("shared") + F.col("rank")).alias("place"))


def sharing(lead: DataFrame, percent: int) -> DataFrame:
    """(a, group_a, b, group_b) of different components that share a leading token and, from the place of the first such
    token on, have enough tokens left for a link."""
    a, b = (lead.select("token", *(F.col(c).alias(f"{c}_{x}") for c in ("node", "root", "n", "place"))) for x in ("a", "b"))
    left = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")) + 1
    fits = (F.col("root_a") != F.col("root_b")) & (F.col("node_a") < F.col("node_b")) & (left * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent)
    return a.join(b, "token").filter(fits).select(F.col("node_a").alias("a"), F.col("root_a").alias("group_a"), F.col("node_b").alias("b"), F.col("root_b").alias("group_b")).distinct()


def marked(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """``texts`` less rows that none of ``nodes`` can be: a fixed number of slots of node hashes, whatever the corpus,
    so that a join with the nodes does not move the other texts. Nodes whose slots are full keep a few too many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(SLOTS * 8, bool)
        for batch in batches:
            bits[slot_of(batch.column(0).to_numpy().view(np.uint64), len(bits))] = True
        cuts = bits.reshape(SLICES, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([np.packbits(c).tobytes() for c in cuts], pa.binary())], names=["slice", "blob"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                one = np.frombuffer(blob.as_buffer(), np.uint8)
                both[k] = both[k] | one if k in both else one
        yield pa.RecordBatch.from_arrays([pa.array(list(both), pa.int32()), pa.array([x.tobytes() for x in both.values()], pa.binary())], names=["slice", "blob"])

    schema = "slice int, blob binary"
    rows = nodes.select("mark").mapInArrow(run, schema).repartition("slice").mapInArrow(add, schema).collect()  # 1 MB in SLICES rows
    found = np.zeros((SLICES, SLOTS // SLICES), np.uint8)
    for r in rows:
        found[r["slice"]] = np.frombuffer(r["blob"], np.uint8)
    shared = nodes.sparkSession.sparkContext.broadcast(found.reshape(-1))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = slot_of(batch.column(0).to_numpy().view(np.uint64), SLOTS * 8)
            yield batch.filter(pa.array((shared.value[slot >> 3] >> (7 - (slot & 7)) & 1).astype(bool)))

    return texts.mapInArrow(chosen, texts.schema)


def opened(groups: DataFrame, roots: DataFrame, sizes: DataFrame, known: DataFrame, one_text: DataFrame, width: int, percent: int) -> DataFrame | None:
    """Pairs still to be compared: (a, b) of different components whose bound lets them link.

    Pivots have met all others of their groups, so only the other nodes of a group with several components are left.
    """
    rooted = groups.select("sig", "node").join(roots, "node", "left").select("sig", "node", F.coalesce("root", "node").alias("root"))
    rooted = tables.written(rooted, "rooted")
    mixed = rooted.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("sig")
    left = tables.written(rooted.join(mixed, "sig", "left_semi").select(F.col("node").alias("mark"), "root").distinct(), "left")
    if left.isEmpty():
        return None
    gone = alone(tokens_of(marked(left, one_text).join(left, "mark"), width, SOME), sizes, percent).select(F.col("node").alias("mark"))
    asking = tables.written(left.join(gone, "mark", "left_anti"), "asking")
    lead = tables.written(leading(tokens_of(marked(asking, one_text).join(asking, "mark"), width), sizes, percent), "leading")
    pairs = tables.written(sharing(lead, percent), "sharing")
    if pairs.isEmpty():
        return None
    queries = pairs.select(F.col("a").alias("node"), F.col("group_b").alias("group")).distinct()
    asked = queries.select("group").distinct()
    members = left.select(F.col("mark").alias("node"), F.col("root").alias("group")).join(asked, "group", "left_semi").join(known, "node").join(sizes, "node")
    members = tables.written(members, "members")
    low = members.groupBy("group").agg(F.min("n").alias("low"))
    matrix = tables.written(unions(members).join(low, "group"), "matrix")
    qualifying = possible(queries.join(sizes, "node").join(known, "node").join(matrix, "group"), ["node", "group"], percent)
    qualifying = qualifying.select(F.col("node").alias("a"), F.col("group").alias("group_b"))
    return pairs.join(qualifying, ["a", "group_b"], "left_semi").select("a", "b").distinct()


def close(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(a, b) whose sizes let them link."""
    a, b = (sizes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}")) for x in ("a", "b"))
    return pairs.join(a, "a").join(b, "b").filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent).drop("n_a", "n_b")


def signature_bits(tokens: int) -> int:
    """Wide enough that few signatures are equal by chance, which would only cost a comparison; short ones move less."""
    return min(64, max(32, int(tokens).bit_length() + 7))


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one component."""
    a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    return pairs.join(a, "a", "left").join(b, "b", "left").filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def join(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, t (hash of its text), n_shingles, component_id, the component's root and own (both
    NULL without words), which name a component also where its ids are NULL, and the row's number if ``docs`` has one."""
    number = [tables.ROW] if tables.ROW in docs.columns else []
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("t"), *number)
    sets = tables.written(sized(docs, width), "sets")
    classes = sets.filter("n > 0").groupBy("mark", "mark2").agg(F.min(F.struct("doc_id", "t")).alias("rep"), F.min("doc_id").alias("first_id"), F.min("n").alias("n"))
    classes = tables.written(classes, "classes")
    sizes = tables.written(classes.groupBy(F.col("mark").alias("node")).agg(F.min("n").alias("n")), "sizes")
    bits = signature_bits(sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    groups = tables.written(grouped(parts(docs, width, percent, bits, common_tokens(docs, width))), "alike")
    groups = tables.written(centered(groups), "groups")
    # first with the pivot a node shares most parts with, then with others that are not in its component by then
    shared = tables.written(groups.groupBy("pivot", "node").agg(F.count("*").alias("parts")), "shared")
    likely = tables.written(close(shared.select(F.col("pivot").alias("a"), F.col("node").alias("b"), "parts"), sizes, percent), "likely")
    best = likely.groupBy(F.col("b").alias("node")).agg(F.max_by("a", F.struct("parts", "a")).alias("pivot"))
    texts = first_texts(shared, best, classes, docs)
    links = tables.written(compared(texts.filter("part < 2"), width, percent), "links")
    roots = components(links)
    one_text = texts.filter("main").select("mark", "text")
    known = tables.written(profiles(one_text, width), "profiles")

    def more(pairs: DataFrame) -> None:
        nonlocal links, roots
        if not pairs.isEmpty():
            links = tables.written(links.union(compared(portioned(pairs).join(one_text, "mark"), width, percent)), "links")
            roots = components(links)

    rest = likely.select("a", "b").join(best.select(F.col("pivot").alias("a"), F.col("node").alias("b")), ["a", "b"], "left_anti")
    more(tables.written(plausible(apart(rest, roots), sizes, known, percent), "rest"))
    pairs = opened(groups, roots, sizes, known, one_text, width, percent)
    if pairs is not None:
        pairs = close(pairs, sizes, percent).join(likely.select("a", "b"), ["a", "b"], "left_anti")
        more(tables.written(plausible(pairs, sizes, known, percent), "opened"))
    placed = classes.join(roots, classes["mark"] == roots["node"], "left").select("mark", "mark2", "first_id", F.coalesce("root", "mark").alias("root"), (F.col("root").isNotNull()).alias("linked"))
    # an unlinked node is a component by its full digest
    placed = placed.withColumn("own", F.when(~F.col("linked"), F.col("mark2")))
    smallest = placed.groupBy(F.col("root").alias("s_root"), F.col("own").alias("s_own")).agg(F.min("first_id").alias("component_id"))
    placed = placed.join(smallest, F.col("root").eqNullSafe(F.col("s_root")) & F.col("own").eqNullSafe(F.col("s_own"))).select("mark", "mark2", "component_id", "root", "own")
    placed = tables.written(placed, "placed")
    with_words = sets.filter("n > 0").join(placed, ["mark", "mark2"]).select("doc_id", "t", F.col("n").alias("n_shingles"), "component_id", "root", "own", *number)
    none = [F.lit(None).cast("long").alias(c) for c in ("root", "own")]
    without = sets.filter("n = 0").select("doc_id", "t", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), *none, *number)
    return with_words.union(without)


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(tables.read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component: that with the smallest id (NULL last), then text hash, then row number. Texts without
    words stay.

    Rows are numbered in a written table, so that repeated rows and rows without an id are told apart.
    """
    numbered = tables.written(docs.withColumn(tables.ROW, F.monotonically_increasing_id()), "numbered")
    found = tables.written(join(numbered).filter("n_shingles > 0"), "joined")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("t"), F.col(tables.ROW).alias("row"))
    first = found.groupBy("root", "own").agg(F.min(order)["row"].alias(tables.ROW))
    gone = found.select(tables.ROW).join(first.select(tables.ROW), tables.ROW, "left_anti")
    return numbered.join(gone, tables.ROW, "left_anti").select(*docs.columns)


#: All pairs that share a shingle, then the transitive closure.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.other) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach ON reach.doc_id = d.doc_id
GROUP BY d.doc_id
"""

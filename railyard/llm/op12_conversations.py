"""Repair of conversation structure by rank-convergence parallel Viterbi.

A conversation is well formed when its roles' initials read ``(s?(ua)+)?``. Rows are kept (cost 0), given the role user
or assistant (2) or deleted (3; blank rows and repeats of an earlier role and text must be), and rows of empty text of
these roles can be inserted anywhere (2); a truncated row that stays adds 1. Of all cheapest repairs the one with the
ASCII-least string of edit initials (D, I, K, R) is taken.

The pattern has four states, so the cheapest way on from a row is a vector of four costs (``back``). Rows of a
conversation are numbered (``order.placed``) and cut into chunks of ``CHUNK`` rows:

* every chunk runs backward from a speculative vector, as if the conversation ended after it;
* fix-up passes: a chunk whose vector at the end turns out to differ (by more than a constant) from the one it started
  from runs again from the new one, beside the old one, and stops at the first row where both differ by a constant only;
* the stitched vectors then tell each chunk, for every state it may be entered in, the least cheapest edits and the
  state it leaves; composing these maps in doubling steps over the chunks gives each its entry.

Chunks in which all rows must be deleted change no vector and are left out of the chain. Conversations of one chunk are
done with the first run. No task holds more than a chunk; texts travel only once, as (role, text's SHA-256) stands for
them elsewhere. The digest of a repaired conversation is one pass over its texts in order, by definition; it is
streamed. The audit text of a conversation has one letter an edit, so that column grows with the conversation.

NULL roles and texts count as one space. Rows are taken by turn, NULLs first; rows of one turn by role, then by the
text's SHA-256; repeated rows are duplicates. NULL conversation ids form one conversation. A role of no or another
initial cannot be kept. An empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm import order, sql, tables

CHUNK = 1024
BLANKS = " \t\n\v\f\r"

# A row's code: two bits for the role's initial, then flags.
INITIALS = "sua"
OTHER, TRUNCATED, BLANK, LIVE = 3, 4, 8, 16

# States: nothing yet, after s, after u, after ua. What one more row of an initial leads to, and the role that is missing.
START, SYSTEM, USER, DONE = range(4)
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": DONE}, {"u": USER})
WANTED = ("u", "u", "a", "u")
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
RELABEL, DELETE, INSERT = 2, 3, 2
END = (0, 4, 2, 0)  # costs at the end of a conversation: insert what is missing

Vector = tuple[int, int, int, int]


def forward(state: int) -> int:
    """The state after the wanted role."""
    return NEXT[state][WANTED[state]]


@lru_cache(maxsize=1 << 16)
def back(after: Vector, code: int) -> Vector:
    """Costs before a row that may stay, from those after it, less their minimum."""
    initial, extra = "sua-"[code & 3], 1 if code & TRUNCATED else 0
    costs = []
    for s in range(4):
        options = [DELETE + after[s], RELABEL + extra + after[forward(s)]]
        if initial in NEXT[s]:
            options.append(extra + after[NEXT[s][initial]])
        costs.append(min(options))
    user, done = min(costs[USER], INSERT + costs[DONE]), min(costs[DONE], INSERT + costs[USER])
    costs = [min(costs[START], INSERT + user), min(costs[SYSTEM], INSERT + user), user, done]
    least = min(costs)
    return tuple(c - least for c in costs)


@lru_cache(maxsize=1 << 18)
def edits(after: Vector, code: int, state: int) -> tuple[str, str, str, int, int]:
    """The least cheapest edits up to and with a row: letters, roles inserted, role given ("" deleted, "k" its own),
    cost, and the state then. Differences of vectors decide, so the constant between rows is found anew."""
    initial, extra = "sua-"[code & 3], 1 if code & TRUNCATED else 0
    letters, inserted, cost = "", "", 0

    def row(s: int) -> list[tuple[int, str, str, int]]:
        found = [(DELETE, "D", "", s)]
        if initial in NEXT[s]:
            found.append((extra, "K", "k", NEXT[s][initial]))
        found.append((RELABEL + extra, "R", WANTED[s], forward(s)))
        return found

    def rest(s: int, inserts: int = 2) -> int:
        best = min(c + after[t] for c, _, _, t in row(s))
        return best if not inserts else min(best, INSERT + rest(forward(s), inserts - 1))

    while True:
        least = rest(state)
        here = {letter: (c, role, t) for c, letter, role, t in row(state) if c + after[t] == least}
        if "D" not in here and INSERT + rest(forward(state), 1) == least:
            letters, inserted, cost, state = letters + "I", inserted + WANTED[state], cost + INSERT, forward(state)
            continue
        letter = min(here)
        c, role, state = here[letter]
        return letters + letter, inserted, role, cost + c, state


def vectors(codes: bytes, end: Vector) -> list[Vector]:
    """The costs before each row of a chunk, and ``end``."""
    found = [end]
    for code in reversed(codes):
        found.append(back(found[-1], code) if code & LIVE else found[-1])
    return found[::-1]


def restarted(codes: bytes, old: Vector, start: Vector, new: Vector) -> Vector:
    """A chunk's start vector from the end vector ``new``; from ``old`` it was ``start``. Stops where both agree."""
    for code in reversed(codes):
        if old == new:
            return start
        if code & LIVE:
            old, new = back(old, code), back(new, code)
    return new


INSERTS = ("", "u", "a", "ua", "au")
GIVEN = ("k", "u", "a")


def traced(codes: bytes, after: list[Vector], state: int) -> tuple[str, str, int, int]:
    """From an entry state: letters, one sign a row (what becomes of it), cost, exit state."""
    letters, signs, cost = [], [], 0
    for i, code in enumerate(codes):
        if code & LIVE:
            found, inserted, role, c, state = edits(after[i + 1], code, state)
            letters.append(found)
            # a deleted row has no inserts before it: they come after all deletions that cost the same
            signs.append(chr(65 + INSERTS.index(inserted) * len(GIVEN) + GIVEN.index(role)) if role else "-")
            cost += c
        else:
            letters.append("D")
            signs.append("-")
            cost += DELETE
    return "".join(letters), "".join(signs), cost, state


def meaning(sign: str) -> tuple[str, str]:
    """(roles inserted before, role given) of a row's sign."""
    number = ord(sign) - 65
    return INSERTS[number // len(GIVEN)], GIVEN[number % len(GIVEN)]


def chunk_codes(codes: pa.Array, alive: pa.Array) -> list[bytes]:
    """Per chunk: its rows' codes, with LIVE set where the row's number is in ``alive``."""
    bounds, marks = (np.concatenate([[0], np.cumsum(x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64) for x in (codes, alive))
    flat = codes.flatten().to_numpy(zero_copy_only=False).astype(np.uint8)
    flat[np.repeat(bounds[:-1], np.diff(marks)) + alive.flatten().to_numpy(zero_copy_only=False)] |= LIVE
    data = flat.tobytes()
    return [data[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def legal_pair(a: int, b: int) -> bool:
    return a < OTHER and b < OTHER and INITIALS[a] + INITIALS[b] in LEGAL


def first_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, chunk, codes, alive) to counts, edge initials, and the start vector of the speculative run."""
    for batch in batches:
        out: list[tuple] = []
        for codes in chunk_codes(batch.column(2), batch.column(3)):
            live = [c for c in codes if c & LIVE]
            blank = sum(1 for c in codes if c & BLANK)
            illegal = sum(not legal_pair(a & 3, b & 3) for a, b in zip(codes, codes[1:]))
            out.append((
                len(codes), len(live), blank, len(codes) - len(live) - blank, sum(1 for c in live if c & TRUNCATED), illegal,
                codes[0] & 3, codes[-1] & 3, list(vectors(codes, END)[0]),
            ))
        kinds = [pa.int64()] * 6 + [pa.int32()] * 2 + [pa.list_(pa.int32())]
        made = [pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 9, kinds)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=["grp", "chunk", *FIRST])


FIRST = ["n", "live", "blank", "duplicate", "truncated", "illegal", "first", "last", "start"]
FIRST_TYPES = "grp string, chunk long, n long, live long, blank long, duplicate long, truncated long, illegal long, first int, last int, start array<int>"


def fix_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, k, codes, alive, end, start, wanted) to the chunk's vectors from the end vector ``wanted``."""
    for batch in batches:
        old, start, new = (batch.column(i).to_pylist() for i in (4, 5, 6))
        made = [list(restarted(c, tuple(a), tuple(s), tuple(b))) for c, a, s, b in zip(chunk_codes(batch.column(2), batch.column(3)), old, start, new)]
        arrays = [batch.column(0), batch.column(1), batch.column(6), pa.array(made, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["grp", "k", "end", "start"])


def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, k, codes, alive, end) to the state left for each state entered."""
    for batch in batches:
        made = []
        for codes, end in zip(chunk_codes(batch.column(2), batch.column(3)), batch.column(4).to_pylist()):
            after = vectors(codes, tuple(end))
            made.append([traced(codes, after, s)[3] for s in range(4)])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.list_(pa.int32()))], names=["grp", "k", "leaves"])


def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, chunk, codes, alive, end, entry) to letters, signs, cost and the state left."""
    for batch in batches:
        out = []
        for codes, end, entry in zip(chunk_codes(batch.column(2), batch.column(3)), batch.column(4).to_pylist(), batch.column(5).to_pylist()):
            out.append(traced(codes, vectors(codes, tuple(end)), entry))
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int32()]
        made = [pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 4, kinds)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=["grp", "chunk", "letters", "signs", "cost", "state"])


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by conversation and place, a sign before its text: the digest of each repaired conversation."""
    current, digest, sign, key, empty = None, None, None, None, True

    def add(role: str, text: str) -> None:
        nonlocal empty
        digest.update(f"{role}:{text}".encode() if empty else f"\n{role}:{text}".encode())
        empty = False

    for batch in batches:
        done: list[tuple[str, str]] = []
        for grp, turn, role, th, text, given in zip(*(c.to_pylist() for c in batch.columns)):
            if grp != current:
                if digest is not None:
                    done.append((current, digest.hexdigest()))
                current, digest, sign, empty = grp, hashlib.sha256(), None, True
            if th is None:  # what is missing at the end
                for initial in given:
                    add(ROLES[initial], "")
            elif given is not None:
                sign, key = given, (turn, role, th)
            elif sign is not None and key == (turn, role, th):
                inserted, own = meaning(sign)
                for initial in inserted:
                    add(ROLES[initial], "")
                add(ROLES.get(own, role), text)
                sign = None
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (zip(*done) if done else [[], []])], names=["grp", "digest"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current]), pa.array([digest.hexdigest()])], names=["grp", "digest"])


def group_of(conv: str = "conv_id") -> Column:
    return F.coalesce(F.concat(F.lit("1"), F.col(conv).cast("string")), F.lit("0"))


def prepared(rows: DataFrame) -> DataFrame:
    """grp, turn, role, th (of the text), code, text: other columns go, NULL roles and texts are one space."""
    space = F.lit(" ")
    rows = rows.select(group_of().alias("grp"), "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    inner = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    code = code + F.when(inner == "", BLANK).when(F.substring(inner, -1, 1).isin(".", "!", "?"), 0).otherwise(TRUNCATED)
    return rows.select("grp", "turn", "role", F.unhex(F.sha2("text", 256)).alias("th"), code.cast("tinyint").alias("code"), "text")


def cut(slim: DataFrame, chunk: int) -> DataFrame:
    """(grp, chunk, rows, codes, alive): all rows of a chunk in order, and the numbers of those that may stay."""
    nodes = order.placed(slim, "grp", ["turn", "role", "th"], "turns")
    number = F.expr(f"place div {chunk}").alias("chunk")
    within = F.expr(f"place % {chunk}").cast("int")
    whole = nodes.groupBy("grp", number).agg(F.sort_array(F.collect_list(F.struct(within.alias("at"), "code", "turn", "role", "th"))).alias("rows"))
    # one row of each role and text stays: the first; a repeated row meets its copies before the shuffle
    first = nodes.filter(F.col("code").bitwiseAND(BLANK) == 0).groupBy("grp", "role", "th").agg(F.min("place").alias("place"))
    alive = first.groupBy("grp", number).agg(F.collect_list(within).alias("alive"))
    none = F.array().cast("array<int>")
    joined = whole.join(alive, ["grp", "chunk"], "left")
    return joined.select("grp", "chunk", "rows", F.col("rows.code").alias("codes"), F.coalesce("alive", none).alias("alive"))


def vector(costs: tuple[int, ...]) -> Column:
    return F.array(*map(F.lit, costs))


def stitched(links: DataFrame, chunks: DataFrame) -> DataFrame:
    """(grp, k, end): the vector at the end of every chunk, from ``links`` (grp, chunk, k, start) of the first run."""
    known = tables.written(links.select("grp", "chunk", "k", vector(END).alias("end"), "start"), "vectors")
    while True:
        after = known.filter("k > 0").select("grp", (F.col("k") - 1).alias("k"), F.col("start").alias("wanted"))
        met = known.join(after, ["grp", "k"], "left").withColumn("wanted", F.coalesce("wanted", vector(END)))
        met = tables.written(met, "met")
        stale = met.filter("end <> wanted")
        if stale.isEmpty():
            return known.select("grp", "k", "end")
        again = stale.join(chunks.select("grp", "chunk", "codes", "alive"), ["grp", "chunk"])
        again = again.select("grp", "k", "codes", "alive", "end", "start", "wanted").mapInArrow(fix_up, "grp string, k long, end array<int>, start array<int>")
        again = again.join(stale.select("grp", "k", "chunk"), ["grp", "k"]).select(*known.columns)
        known = tables.written(met.filter("end = wanted").select(*known.columns).unionByName(again), "vectors")


def entries(links: DataFrame, chunks: DataFrame) -> DataFrame:
    """(grp, k, entry) from ``links`` (grp, chunk, k, end): maps of several chunks are composed, twice as many a round."""
    maps = links.join(chunks.select("grp", "chunk", "codes", "alive"), ["grp", "chunk"]).select("grp", "k", "codes", "alive", "end")
    maps = maps.mapInArrow(exits, "grp string, k long, leaves array<int>")
    fixed = F.array_repeat(F.col("leaves")[START], 4)  # a conversation begins in one state
    maps = tables.written(maps.withColumn("leaves", F.when(F.col("k") == 0, fixed).otherwise(F.col("leaves"))), "maps")
    step = 1
    while not maps.filter("size(array_distinct(leaves)) > 1").isEmpty():
        before = maps.select("grp", (F.col("k") + step).alias("k"), F.col("leaves").alias("earlier"))
        both = maps.join(before, ["grp", "k"], "left")
        through = F.transform("earlier", lambda s: F.element_at("leaves", s + 1))
        maps = tables.written(both.select("grp", "k", F.coalesce(through, "leaves").alias("leaves")), "maps")
        step *= 2
    begin = maps.filter("k = 0").select("grp", "k", F.lit(START).alias("entry"))
    return begin.unionByName(maps.select("grp", (F.col("k") + 1).alias("k"), F.col("leaves")[0].alias("entry")))


class Repair:
    """``chunks``: rows and what becomes of each (one sign); ``conversations``: counts, cost and audit of each."""

    def __init__(self, rows: DataFrame, chunks: DataFrame, conversations: DataFrame):
        self.rows, self.chunks, self.conversations = rows, chunks, conversations

    def _kept(self) -> DataFrame:
        """The rows that stay, without texts."""
        rows = self.chunks.select("grp", "signs", F.explode("rows").alias("r"))
        rows = rows.select("grp", "r.turn", "r.role", "r.th", F.expr("substring(signs, r.at + 1, 1)").alias("sign"))
        return rows.filter("sign <> '-'")

    def digests(self) -> DataFrame:
        """(grp, digest) of the conversations of which anything is left."""
        absent = F.lit(None)
        texts = self.rows.filter(F.col("code").bitwiseAND(BLANK) == 0)
        texts = texts.select("grp", F.lit(0).alias("part"), "turn", "role", "th", F.lit(1).alias("kind"), "text", absent.cast("string").alias("given"))
        kept = self._kept().select("grp", F.lit(0).alias("part"), "turn", "role", "th", F.lit(0).alias("kind"), absent.cast("string").alias("text"), F.col("sign").alias("given"))
        tails = self.conversations.filter("missing <> ''")
        tails = tails.select("grp", F.lit(1).alias("part"), *(absent.cast(texts.schema[c].dataType).alias(c) for c in ("turn", "role", "th")), F.lit(0).alias("kind"), absent.cast("string").alias("text"), F.col("missing").alias("given"))
        rows = texts.unionByName(kept).unionByName(tails).repartition("grp").sortWithinPartitions("grp", "part", "turn", "role", "th", "kind")
        return rows.select("grp", "turn", "role", "th", "text", "given").mapInArrow(digests, "grp string, digest string")


def repair(rows: DataFrame, chunk: int = CHUNK) -> Repair:
    """Of rows (conv_id, turn, role, text): counts of faults, the cheapest edits and the repaired conversations."""
    rows = prepared(rows)
    slim = tables.written(rows.drop("text"), "slim")
    chunks = tables.written(cut(slim, chunk), "chunks")
    ran = chunks.select("grp", "chunk", "codes", "alive").mapInArrow(first_run, FIRST_TYPES)
    ran = tables.written(ran, "first")
    chain = order.placed(ran.filter("live > 0").select("grp", "chunk", "start"), "grp", ["chunk"], "chain")
    chain = tables.written(chain.select("grp", "chunk", F.col("place").alias("k"), "size", "start"), "links")
    one, more = chain.filter("size = 1"), chain.filter("size > 1")
    solved = one.select("grp", "chunk", "k", "size", vector(END).alias("end"), F.lit(START).alias("entry"))
    if not more.isEmpty():
        ended = tables.written(more.select("grp", "chunk", "k", "size").join(stitched(more, chunks), ["grp", "k"]), "ended")
        solved = solved.unionByName(ended.join(entries(ended, chunks), ["grp", "k"]).select(*solved.columns))
    solved = solved.select("grp", "chunk", "end", "entry", (F.col("k") + 1 == F.col("size")).alias("ends"))
    part = chunks.select("grp", "chunk", "codes", "alive").join(solved, ["grp", "chunk"])
    part = part.select("grp", "chunk", "codes", "alive", "end", "entry").mapInArrow(trace, "grp string, chunk long, letters string, signs string, cost long, state int")
    part = part.join(solved.select("grp", "chunk", "ends"), ["grp", "chunk"])
    missing = F.when(F.col("ends"), F.when(F.col("state") == SYSTEM, "ua").when(F.col("state") == USER, "a")).otherwise(F.lit(None))
    part = tables.written(part.select("grp", "chunk", "letters", "signs", "cost", missing.alias("missing")), "part")
    pieces = ran.join(part, ["grp", "chunk"], "left").withColumns({
        "letters": F.coalesce("letters", F.expr("repeat('D', int(n))")),
        "cost": F.coalesce("cost", F.col("n") * DELETE),
    })
    sums = pieces.groupBy("grp").agg(
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce(F.max("missing"), F.lit("")).alias("missing"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "letters"))), lambda x: x["letters"]), "").alias("audit"),
    )
    sums = sums.withColumns({"cost": F.col("cost") + INSERT * F.length("missing"), "audit": F.concat("audit", F.expr("repeat('I', length(missing))"))})
    pair = F.concat(*(F.substring(F.lit("sua-"), F.col(c) + 1, F.lit(1)) for c in ("earlier", "first")))
    edges = ran.filter("chunk > 0").join(ran.select("grp", (F.col("chunk") + 1).alias("chunk"), F.col("last").alias("earlier")), ["grp", "chunk"])
    edges = edges.groupBy("grp").agg(F.sum(F.when(pair.isin(*LEGAL), 0).otherwise(1)).alias("at_edges"))
    turns = slim.groupBy("grp").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    found = sums.join(edges, "grp", "left").join(turns, "grp").withColumns({
        "illegal": F.col("illegal") + F.coalesce("at_edges", F.lit(0)), "gaps": F.coalesce("gaps", F.lit(0)),
    }).drop("at_edges")
    found = tables.written(found, "conversations")
    return Repair(rows, chunks.join(part.select("grp", "chunk", "signs"), ["grp", "chunk"]), found)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows changed by the CRC-32 of conversation and turn: dropped, emptied, stripped of [.!?], repeated, made user's."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    hit = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", space)
    text = F.when(hit == 1, "").when(hit == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(hit == 4, "user").otherwise(F.coalesce("role", space))
    copies = F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1)
    made = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"))
    return made.drop("copy")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.read(spark, sf_dir, "conversations")
    fixed = repair(damaged(rows))
    every = rows.select("conv_id").distinct().withColumn("grp", group_of())
    found = every.join(fixed.conversations, "grp", "left").join(fixed.digests(), "grp", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return found.select(
        "conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.lit(nothing)).alias("repaired_sha256"),
    )


def _oracle() -> str:
    """Plain SQL: row by row, the cheapest (cost, audit, repaired rows) that leads to each state."""
    gone = "{'c': 1000000000::BIGINT, 'a': '', 'r': ''}"

    def best(options: list[str]) -> str:
        return f"list_sort([{', '.join(options)}])[1]"

    def plus(state: str, cost: str, letter: str, row: str = "''") -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'r': {state}.r || {row}}}"

    def closed(source: str, keep: str) -> str:
        """Inserts: users after 0, 1 and 3, then assistants after 2."""
        user, assistant = "(chr(10) || 'user:')", "(chr(10) || 'assistant:')"
        users = best(["v2", *(plus(f"v{k}", "2", "I", user) for k in (0, 1, 3))])
        return f"SELECT {keep}, v0, v1, v2, {best(['v3', plus('v2', '2', 'I', assistant)])} AS v3 FROM (SELECT {keep}, v0, v1, {users} AS v2, v3 FROM ({source}))"

    def only(test: str, option: str) -> str:
        return f"CASE WHEN {test} THEN {option} ELSE {gone} END"

    own, free = "(chr(10) || role || ':' || text)", "NOT forced"
    user, assistant = ("(chr(10) || '" + r + ":' || text)" for r in ("user", "assistant"))
    into_user = [only(f"{free} AND initial = 'u'", plus(f"v{k}", "t", "K", own)) for k in (0, 1, 3)] + [only(free, plus(f"v{k}", "2 + t", "R", user)) for k in (0, 1, 3)]
    step = (
        f"SELECT w.conv, w.i + 1 AS i, {plus('v0', '3', 'D')} AS v0, {best([plus('v1', '3', 'D'), only(free + ' AND initial = ' + repr('s'), plus('v0', 't', 'K', own))])} AS v1, "
        f"{best([plus('v2', '3', 'D'), *into_user])} AS v2, "
        f"{best([plus('v3', '3', 'D'), only(free + ' AND initial = ' + repr('a'), plus('v2', 't', 'K', own)), only(free, plus('v2', '2 + t', 'R', assistant))])} AS v3 "
        "FROM walk w JOIN marked m ON m.conv = w.conv AND m.i = w.i + 1"
    )
    begin = f"SELECT DISTINCT conv, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 'r': ''}} AS v0, {gone} AS v1, {gone} AS v2, {gone} AS v3 FROM hit"
    keyed = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    return (
        f"WITH RECURSIVE {sql.CRC32}, hit AS (SELECT conv_id, coalesce('1' || conv_id, '0') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, "
        f"{sql.crc32(keyed)} % 20 AS d FROM conversations, crc_bytes), "
        "hurt AS (SELECT conv, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, "
        "CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, "
        "unnest(range(CASE WHEN d = 0 THEN 0 WHEN d = 3 THEN 2 ELSE 1 END)) AS copy FROM hit), "
        "numbered AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text)) AS i, role[1] AS initial FROM hurt), "
        "judged AS (SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again, "
        "NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS open, lead(initial) OVER (PARTITION BY conv ORDER BY i) AS follower FROM numbered), "
        "marked AS (SELECT *, blank OR again AS forced, open::INT AS t FROM judged), "
        "counted AS (SELECT conv, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, "
        "count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (open AND NOT blank AND NOT again) AS truncated, "
        "count(*) FILTER (follower IS NOT NULL AND initial || follower NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv), "
        f"walk AS ({closed(begin, 'conv, i')} UNION ALL {closed(step, 'conv, i')}), "
        f"ended AS (SELECT w.conv, {best(['v0', 'v3'])} AS v FROM walk w JOIN counted c ON c.conv = w.conv AND c.n = w.i) "
        "SELECT DISTINCT h.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate, "
        "coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(e.v.c, 0)::BIGINT AS cost, coalesce(e.v.a, '') AS audit, "
        "sha256(coalesce(e.v.r[2:], '')) AS repaired_sha256 FROM hit h LEFT JOIN counted c ON c.conv = h.conv LEFT JOIN ended e ON e.conv = h.conv"
    )


ORACLE = _oracle()

"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

Frequent words and their ids are compiled into an acyclic automaton whose equal suffix parts are shared. Every arc
carries the smallest part of a rank, so that the sum along a path numbers the words in sorted order; the ids lie in
one array under that number. The arrays go into one file per executor folder, which tasks memory-map. Words that the
lexicon lacks are merged by the vocabulary's ranks, so the result is exact whatever the lexicon holds.

Every text is encoded whole. NULL counts as the empty text, which has no tokens; repeated rows get one result each;
all columns but ``doc_id`` and ``text`` are ignored, so they may have any name.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm import tables

# The split pattern of this public vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same for texts within U+0000 to U+00FF, whose letters, numbers and spaces can be listed; a third of the time.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
LATIN_PATTERN = f"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
PIECE_CHARS = 1 << 18


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary: printable Latin-1 bytes stand
    for themselves, the others for the letters from U+0100 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in printable}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(0x100 + len(letters) - len(printable))
    return letters


class Vocabulary:
    """Ids, merge ranks and added tokens of a byte-level BPE file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        back = {letter: b for b, letter in byte_letters().items()}
        self.id_of = {bytes(back[c] for c in token): i for token, i in spec["model"]["vocab"].items() if all(c in back for c in token)}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        merges = [[bytes(back[c] for c in part) for part in (m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        self.byte_id = np.array([self.id_of[bytes([b])] for b in range(256)], np.int64)
        self.joined = np.array([self.id_of[a + b] for a, b in merges], np.int64)
        self.pairs = Pairs(np.array([self.id_of[a] for a, _ in merges], np.int64), np.array([self.id_of[b] for _, b in merges], np.int64))
        self.bytes_of = {i: token for token, i in self.id_of.items()} | {i: t.encode() for t, i in self.added.items()}

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word: its pair of lowest rank is joined, leftmost first, until none is left.

        All words take a step at a time. ``symbol`` holds the parts of the words that still have a pair to join,
        ``rank`` the rank of the pair that begins at a part.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbol = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        rank = np.full(len(symbol), NO_PAIR, np.int64)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inside] = self.pairs.find(symbol[inside], symbol[inside + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            best = np.minimum.reduceat(rank << 32 | np.arange(len(symbol)), starts)
            live = best >> 32 < NO_PAIR
            at, joined = best[live] & 0xFFFFFFFF, best[live] >> 32
            symbol[at] = self.joined[joined]
            going = np.repeat(live, np.diff(np.concatenate([starts, [len(symbol)]])))
            done.append((owner[~going], symbol[~going]))
            keep = going.copy()
            keep[at + 1] = False
            at = (np.cumsum(keep) - 1)[at]
            symbol, owner, rank = symbol[keep], owner[keep], rank[keep]
            for i in (at, at[at > 0] - 1):
                i = i[i + 1 < len(symbol)]
                same = owner[i] == owner[i + 1]
                rank[i[same]] = self.pairs.find(symbol[i[same]], symbol[i[same] + 1])
            rank[at[(at + 1 >= len(symbol)) | (owner[at] != owner[np.minimum(at + 1, len(symbol) - 1)])]] = NO_PAIR
        owners = np.concatenate([o for o, _ in done]) if done else np.zeros(0, np.int64)
        symbols = np.concatenate([x for _, x in done]) if done else np.zeros(0, np.int64)
        symbols = symbols[np.argsort(owners, kind="stable")].tolist()
        ends = np.cumsum(np.bincount(owners, minlength=len(words))).tolist()
        return [symbols[i:j] for i, j in zip([0, *ends[:-1]], ends)]


NO_PAIR = 1 << 30


class Pairs:
    """Rank of a pair of ids, looked up for many pairs at once in an open-addressed table."""

    BITS = 18

    def __init__(self, left: np.ndarray, right: np.ndarray):
        self.bits = max(self.BITS, int(len(left)).bit_length() + 2)
        self.key = np.full(1 << self.bits, -1, np.int64)
        self.value = np.full(1 << self.bits, NO_PAIR, np.int64)
        wanted = left.astype(np.int64) << 32 | right.astype(np.int64)
        place, rest = self._slot(wanted), np.arange(len(wanted))
        while len(rest):
            free = self.key[place[rest]] == -1
            self.key[place[rest[free]]] = wanted[rest[free]]  # of several, one stays
            won = self.key[place[rest]] == wanted[rest]
            self.value[place[rest[won]]] = rest[won]
            rest = rest[~won]
            place[rest] = (place[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << 32 | right
        place, out = self._slot(wanted), np.full(len(wanted), NO_PAIR, np.int64)
        rest = np.arange(len(wanted))
        while len(rest):
            there = self.key[place[rest]]
            hit = there == wanted[rest]
            out[rest[hit]] = self.value[place[rest[hit]]]
            rest = rest[~hit & (there != -1)]
            place[rest] = (place[rest] + 1) & ((1 << self.bits) - 1)
        return out


class Lexicon:
    """A minimal acyclic automaton over bytes whose arcs carry rank parts, as flat arrays.

    Arcs of a state are consecutive: ``label``, ``target`` and ``add`` (words before this arc's). ``first`` has a
    state's first arc, ``final`` whether a word ends in it. Word number r has ids ``ids[begin[r]:begin[r + 1]]``.
    """

    NAMES = ("label", "target", "add", "first", "final", "begin", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)
        # (state, byte) -> arc, looked up for many words at once
        self.state = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        self.key = self.state.astype(np.int64) * 256 + self.label

    @classmethod
    def compile(cls, words: dict[bytes, list[int]]) -> "Lexicon":
        """From sorted words: a state is frozen, and shared with an equal one, when the next word leaves it."""
        registry: dict[tuple, int] = {}
        states: list[tuple[bool, list[tuple[int, int]]]] = []  # children come before their parents
        sizes: list[int] = []
        path: list[list] = [[False, []]]  # states on the way to the last word: final, frozen arcs
        last = b""

        def freeze(down_to: int) -> None:
            while len(path) > down_to:
                final, arcs = path.pop()
                key = (final, tuple(arcs))
                if key not in registry:
                    registry[key] = len(states)
                    states.append((final, arcs))
                    sizes.append(final + sum(sizes[t] for _, t in arcs))
                if path:
                    path[-1][1].append((last[len(path) - 1], registry[key]))

        ordered = sorted(words)
        for word in ordered:
            shared = 0
            while shared < min(len(word), len(last)) and word[shared] == last[shared]:
                shared += 1
            freeze(shared + 1)
            last = word
            while len(path) <= len(word):
                path.append([False, []])
            path[-1][0] = True
        freeze(0)
        # the root was frozen last; number it 0 by turning the order around
        n = len(states)
        label, target, add, first, final = [], [], [], [0], []
        for s in range(n - 1, -1, -1):
            is_final, arcs = states[s]
            before = int(is_final)
            for b, t in arcs:
                label.append(b)
                target.append(n - 1 - t)
                add.append(before)
                before += sizes[t]
            first.append(len(label))
            final.append(is_final)
        begin = np.concatenate([[0], np.cumsum([len(words[w]) for w in ordered])]).astype(np.int64)
        return cls({
            "label": np.array(label, np.int64), "target": np.array(target, np.int32), "add": np.array(add, np.int32),
            "first": np.array(first, np.int32), "final": np.array(final, bool), "begin": begin,
            "ids": np.array([i for w in ordered for i in words[w]], np.int32),
        })

    def save(self, folder: str) -> None:
        """Through a temporary folder name; whoever comes first wins, all write the same."""
        if os.path.isdir(folder):
            return
        temporary = tempfile.mkdtemp(dir=os.path.dirname(folder))
        for name in self.NAMES:
            np.save(f"{temporary}/{name}.npy", self.__dict__[name])
        try:
            os.rename(temporary, folder)
        except OSError:
            if not os.path.isdir(folder):
                raise

    @classmethod
    def mapped(cls, folder: str) -> "Lexicon":
        return cls({name: np.load(f"{folder}/{name}.npy", mmap_mode="r") for name in cls.NAMES})

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """Each word's number, -1 where the lexicon lacks it; all words advance byte by byte together."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(words) else np.zeros(0, np.int64)
        out = np.full(len(words), -1, np.int64)
        live = np.arange(len(words))
        state, rank = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        step = 0
        while len(live):
            ended = lengths[live] == step
            done = live[ended & self.final[state]]
            out[done] = rank[ended & self.final[state]]
            live, state, rank = live[~ended], state[~ended], rank[~ended]
            if not len(live):
                break
            want = state * 256 + data[at[live] + step]
            arc = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1) if len(self.key) else np.zeros(len(live), int)
            found = self.key[arc] == want if len(self.key) else np.zeros(len(live), bool)
            live, arc = live[found], arc[found]
            state, rank = self.target[arc].astype(np.int64), rank[found] + self.add[arc]
            step += 1
        return out


def lexicon_words(vocabulary: Vocabulary) -> dict[bytes, list[int]]:
    """The frequent words: BPE merges frequent strings, so its own tokens are those of the text it was made for."""
    words = [token for token in vocabulary.id_of if len(token) > 1]
    return dict(zip(words, vocabulary.merge(words)))


class Codec:
    """Encodes and decodes texts. Ids of a batch's distinct words are found once per piece of text."""

    KEEP_BYTES, ENTRY_BYTES = 32 << 20, 200

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.any_words, self.latin_words = regex.compile(PATTERN), re.compile(LATIN_PATTERN)
        self.added = regex.compile("|".join(regex.escape(a) for a in sorted(vocabulary.added, key=len, reverse=True))) if vocabulary.added else None
        self.known: dict[str, str] = {}
        self.held = 0
        self.token = [vocabulary.bytes_of.get(i, b"") for i in range(max(vocabulary.bytes_of, default=-1) + 1)]
        self.token_data = np.frombuffer(b"".join(self.token), np.uint8)
        self.token_length = np.array([len(t) for t in self.token], np.int64)
        self.token_end = np.cumsum(self.token_length)

    def words(self, piece: str) -> list[str]:
        try:
            piece.encode("latin-1")
        except UnicodeEncodeError:
            return self.any_words.findall(piece)
        return self.latin_words.findall(piece)

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if self.held > self.KEEP_BYTES:
            self.known.clear()  # a bounded store; nothing but speed depends on it
            self.held, new = 0, list(words)
        coded = [w.encode() for w in new]
        ranks = self.lexicon.ranks(coded)
        begin, ids = self.lexicon.begin, self.lexicon.ids
        for k in np.flatnonzero(ranks >= 0).tolist():
            self.known[new[k]] = ",".join(map(str, ids[begin[ranks[k]] : begin[ranks[k] + 1]].tolist()))
        unseen = np.flatnonzero(ranks < 0).tolist()
        for k, parts in zip(unseen, self.vocabulary.merge([coded[k] for k in unseen])):
            self.known[new[k]] = ",".join(map(str, parts))
        self.held += sum(len(w) + len(self.known[w]) + self.ENTRY_BYTES for w in new)

    def pieces(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text cut at added tokens; True for these. A very long piece goes on in parts, cut where no word
        is: before a single space that follows a letter and precedes one."""
        at = 0
        for m in self.added.finditer(text) if self.added is not None else ():
            yield from self._parts(text[at : m.start()])
            yield m.group(), True
            at = m.end()
        yield from self._parts(text[at:])

    CUT = regex.compile(r"(?<=\p{L})(?= \p{L})")

    def _parts(self, piece: str) -> Iterator[tuple[str, bool]]:
        at = 0
        while len(piece) - at > PIECE_CHARS:
            cut = self.CUT.search(piece, at + PIECE_CHARS)
            if cut is None:
                break
            yield piece[at : cut.start()], False
            at = cut.start()
        if at < len(piece):
            yield piece[at:], False

    def encode_all(self, texts: list[str]) -> list[str]:
        """Each text's ids as decimal numbers, comma-joined. Words are looked up for many texts together."""
        out: list[list[str]] = [[] for _ in texts]
        held: list[tuple[int, list[str] | str]] = []
        size = 0

        def flush() -> None:
            self.learn(set().union(*(words for _, words in held if not isinstance(words, str))))
            known = self.known
            for k, words in held:
                out[k].append(words if isinstance(words, str) else ",".join([known[w] for w in words]))
            held.clear()

        for k, text in enumerate(texts):
            for piece, is_added in self.pieces(text):
                held.append((k, str(self.vocabulary.added[piece]) if is_added else self.words(piece)))
                size += len(piece)
                if size > 4 * PIECE_CHARS:
                    flush()
                    size = 0
        flush()
        return [",".join(parts) for parts in out]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' bytes in a row, as UTF-8; bytes that are none become U+FFFD."""
        end = self.token_end[ids]
        length = self.token_length[ids]
        place = np.cumsum(length)
        total = int(place[-1]) if len(place) else 0
        at = np.arange(total) + np.repeat(end - place, length)
        return self.token_data[at].tobytes().decode("utf-8", "replace")

    @staticmethod
    def ids(coded: str) -> np.ndarray:
        return np.fromstring(coded, np.int32, sep=",") if coded else np.zeros(0, np.int32)


_CODECS: dict[str, Codec] = {}


def codec(spec: str) -> Codec:
    """This process's codec. The first task of a machine compiles the lexicon, the others map it."""
    mark = hashlib.sha256(spec.encode()).hexdigest()[:20]
    if mark not in _CODECS:
        vocabulary = Vocabulary(spec)
        folder = os.path.join(tempfile.gettempdir(), f"lexicon-{mark}")
        if not os.path.isdir(folder):
            Lexicon.compile(lexicon_words(vocabulary)).save(folder)
        _CODECS[mark] = Codec(vocabulary, Lexicon.mapped(folder))
    return _CODECS[mark]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def shipped(spark: SparkSession, path: str) -> str:
    """The vocabulary file's name among the files that Spark copies to every executor."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def encode(docs: DataFrame, vocabulary: str | None = None, keep_ids: bool = True) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids (when ``keep_ids``), ids_sha256, decoded_sha256."""
    name = shipped(docs.sparkSession, vocabulary or default_vocabulary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(SparkFiles.get(name), encoding="utf-8") as file:
            tool = codec(file.read())
        for batch in batches:
            doc_id, texts = batch.column(0), batch.column(1)
            columns: dict[str, list] = {"n_tokens": [], "ids": [], "ids_sha256": [], "decoded_sha256": []}
            for coded in tool.encode_all([value or "" for value in texts.to_pylist()]):
                ids = tool.ids(coded)
                columns["n_tokens"].append(len(ids))
                if keep_ids:
                    columns["ids"].append(ids)
                columns["ids_sha256"].append(hashlib.sha256(coded.encode()).hexdigest())
                columns["decoded_sha256"].append(hashlib.sha256(tool.decode(ids).encode()).hexdigest())
            made = [doc_id, pa.array(columns["n_tokens"], pa.int64())]
            names = ["doc_id", "n_tokens"]
            if keep_ids:
                made.append(pa.array(columns["ids"], pa.list_(pa.int32())))
                names.append("ids")
            made += [pa.array(columns["ids_sha256"], pa.string()), pa.array(columns["decoded_sha256"], pa.string())]
            yield pa.RecordBatch.from_arrays(made, names=[*names, "ids_sha256", "decoded_sha256"])

    ids = "ids array<int>, " if keep_ids else ""
    return tables.keyed(docs).mapInArrow(run, f"doc_id {_id_type(docs)}, n_tokens long, {ids}ids_sha256 string, decoded_sha256 string")


def decode(coded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Texts from ``ids``: doc_id, text. NULL ids give the empty text."""
    name = shipped(coded.sparkSession, vocabulary or default_vocabulary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(SparkFiles.get(name), encoding="utf-8") as file:
            tool = codec(file.read())
        for batch in batches:
            texts = [tool.decode(np.array(ids.as_py() or [], np.int64)) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return coded.select("doc_id", F.col("ids")).mapInArrow(run, f"doc_id {_id_type(coded)}, text string")


def _id_type(df: DataFrame) -> str:
    return dict(df.dtypes)["doc_id"]


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(tables.read(spark, sf_dir, "documents"), keep_ids=False)

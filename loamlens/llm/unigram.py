"""SentencePiece encoding by unigram Viterbi over a double-array trie, and decoding."""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from loamlens.llm.common import packed

#: white space marker
MARK = "▁"
#: a character without a piece of its own costs this more than the worst piece
UNKNOWN_PENALTY = 10.0
#: rows given back at once, and remembered words of a task
ROWS, REMEMBERED, LONGEST_REMEMBERED = 512, 500_000, 64


@dataclass(frozen=True)
class Pieces:
    """A vocabulary: texts, log scores, and the ids that only byte fallback uses."""

    texts: tuple[str, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]  # of the bytes 0 to 255; empty if there is no byte fallback
    plain_ids: tuple[int, ...]  # ids found in text
    unknown_id: int


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    """Read a ``.model`` file; its scores are taken as log scores whatever trained them."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    by_byte = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
    special = lambda i: (model.is_byte(i) or model.is_unknown(i) or model.is_control(i)
                         or model.is_unused(i))
    return Pieces(tuple(model.id_to_piece(i) for i in ids), tuple(model.get_score(i) for i in ids),
                  tuple(by_byte[b] for b in range(256)) if len(by_byte) == 256 else (),
                  tuple(i for i in ids if not special(i)), model.unk_id())


class DoubleArray:
    """A trie over bytes: the child of ``s`` by ``c`` is ``base[s] + c + 1`` if ``check`` there is ``s``.

    ``value`` is the id of the piece that ends in a state, or -1.
    """

    def __init__(self, keys: dict[bytes, int]):
        tree: dict = {}
        for key, value in keys.items():
            node = tree
            for c in key:
                node = node.setdefault(c, {})
            node[-1] = value
        base, check, value = [0], [0], [-1]
        # nodes with many children come first; a search goes on where the last for as many ended
        reached: dict[int, int] = {}
        last = 0
        pending = [(-len(tree), 0, 0, tree)]
        while pending:
            _, state, _, node = heappop(pending)
            value[state] = node.get(-1, -1)
            codes = sorted(c + 1 for c in node if c >= 0)
            if not codes:
                continue
            at = max(reached.get(len(codes), 1), codes[0])
            while True:
                short = at + 257 - len(check)
                if short > 0:
                    base += [0] * short
                    check += [-1] * short
                    value += [-1] * short
                if check[at] < 0 and all(check[at - codes[0] + c] < 0 for c in codes):
                    break
                at += 1
            base[state], reached[len(codes)] = at - codes[0], at
            for code in codes:
                child = base[state] + code
                check[child] = state
                last += 1
                heappush(pending, (-len(node[code - 1]), child, last, node[code - 1]))
        self.base, self.check, self.value = (x + [f] * 257 for x, f in ((base, 0), (check, -1), (value, -1)))


_NONE = float("-inf")
#: bytes of a character by its first byte
_WIDTH = [1 if b < 0xC0 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4 for b in range(256)]


class Encoder:
    """Best segmentation by summed scores, over UTF-8 bytes."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.trie = DoubleArray({pieces.texts[i].encode(): i for i in pieces.plain_ids})
        plain = [pieces.scores[i] for i in pieces.plain_ids]
        self.unknown = min(plain, default=0.0) - UNKNOWN_PENALTY
        # without a piece that has a marker behind another character, words can be cut apart
        self.by_word = not any(re.search(f"[^{MARK}]{MARK}", pieces.texts[i])
                               for i in pieces.plain_ids)
        self.known: dict[str, bytes] = {}  # ids as int32

    def __call__(self, text: str | None) -> np.ndarray:
        """Ids of ``text``, after a marker in front and one for each space; none if it's empty."""
        if not text:
            return np.empty(0, np.int32)
        marked = MARK + text.replace(" ", MARK)
        words = re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", marked) if self.by_word else [marked]
        known, ids = self.known, []
        for word in words:
            found = known.get(word)
            if found is None:
                found = array("i", self.viterbi(word)).tobytes()
                if len(known) < REMEMBERED and len(word) <= LONGEST_REMEMBERED:
                    known[word] = found
            ids.append(found)
        return np.frombuffer(b"".join(ids), np.int32)

    def forget(self) -> None:
        """Remembered words go, so that a worker that waits for other work doesn't hold them."""
        self.known.clear()

    def viterbi(self, text: str) -> tuple[int, ...]:
        """Ties go to the piece that starts first."""
        raw = text.encode("utf-8", "surrogatepass")
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        scores, unknown, n = self.pieces.scores, self.unknown, len(raw)
        best, start, chosen = [_NONE] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        at = 0
        while at < n:
            width = _WIDTH[raw[at]]
            so_far, state, end, single = best[at], 0, at, False
            while end < n:
                target = base[state] + raw[end] + 1
                if check[target] != state:
                    break
                state, end = target, end + 1
                piece = value[state]
                if piece >= 0:
                    score = so_far + scores[piece]
                    if score > best[end]:
                        best[end], start[end], chosen[end] = score, at, piece
                    single = single or end - at == width
            if not single:
                end, score = at + width, so_far + unknown
                if score > best[end]:
                    best[end], start[end], chosen[end] = score, at, -1
            at += width
        ids, byte_ids, end = [], self.pieces.byte_ids, n
        while end:
            begin = start[end]
            if chosen[end] >= 0:
                ids.append(chosen[end])
            elif byte_ids:
                ids.extend(byte_ids[b] for b in reversed(raw[begin:end]))
            else:
                ids.append(self.pieces.unknown_id)
            end = begin
        return tuple(reversed(ids))


class Decoder:
    """Pieces joined, byte pieces as UTF-8, markers as spaces, without the marker put in front."""

    def __init__(self, pieces: Pieces):
        plain = set(pieces.plain_ids)
        self.raw = [t.replace(MARK, " ").encode() if i in plain else b""
                    for i, t in enumerate(pieces.texts)]
        for b, i in enumerate(pieces.byte_ids):
            self.raw[i] = bytes([b])
        self.raw[pieces.unknown_id] = " ⁇ ".encode()

    def forget(self) -> None:
        """Nothing of the texts is kept."""

    def __call__(self, ids) -> str:
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace").removeprefix(" ")


_shared: dict = {}


def _of(kind, pieces: Pieces):
    """One encoder or decoder per worker and vocabulary."""
    key = kind, hash(pieces)
    if key not in _shared:
        _shared[key] = kind(pieces)
    return _shared[key]


def _with_column(df: DataFrame, name: str, kind: StructField, of, tool, pieces, make) -> DataFrame:
    """``df`` with what ``make`` gives for the array that ``of`` takes from a batch, by an encoder or decoder."""
    schema = StructType([*df.schema.fields, StructField(name, kind)])
    kept = df.columns

    def run(batches):
        does = _of(tool, pieces.value)
        try:
            for whole in batches:
                for at in range(0, whole.num_rows, ROWS):
                    batch = whole.slice(at, ROWS)
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c) for c in kept), make(does, of(batch))], [*kept, name])
        finally:
            does.forget()

    return df.mapInArrow(run, schema)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``row`` (the whole row of ``docs``) and ``ids`` of its ``text``.

    Null and empty texts have no ids. The vocabulary is read once by the driver and sent along: its
    size is that of the file. Nothing is shuffled.
    """
    pieces = docs.sparkSession.sparkContext.broadcast(load(path))

    def make(encode, texts):
        parts = [encode(t) for t in texts.to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(
            np.concatenate([np.empty(0, np.int32), *parts]).astype(np.int32)))

    # the text is read from the row, so that a batch holds it once; rows are never null
    at = min(range(len(docs.columns)), key=lambda i: (docs.columns[i] != "text", docs.columns[i].lower() != "text"))
    return _with_column(packed(docs), "ids", ArrayType(IntegerType()), lambda b: pc.struct_field(b.column("row"), [at]),
                        Encoder, pieces, make)


def decoded(df: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``df`` with the text of its ``ids``; null ids give an empty text.

    A marker that stood in the original comes back as a space, as the format can't tell them apart.
    """
    pieces = df.sparkSession.sparkContext.broadcast(load(path))

    def make(decode, column):
        return pa.array([decode(i.values.to_numpy().tolist() if i.is_valid else ()) for i in column],
                        pa.string())

    return _with_column(df, name, StringType(), lambda b: b.column(ids), Decoder, pieces, make)


def default_model(spark: SparkSession) -> str:
    """The vocabulary file named by ``loamlens.pieces``, else the machine's public one."""
    return spark.conf.get("loamlens.pieces", "/opt/tokenizers/piece_bpe_32k.model")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` of every row with the number and a digest of its ids, and whether they give it back.

    ``text_back`` is true if decoding returns the text with every marker in it as a space; a null text
    counts as empty.
    """
    there = encoded(docs.select("doc_id", "text"), path).select(
        F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"), "ids")
    back = decoded(there, path)
    spaced = F.replace(F.coalesce("text", F.lit("")), F.lit(MARK), F.lit(" "))
    return back.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"),
                       F.xxhash64("ids").alias("ids_hash"), (F.col("decoded") == spaced).alias("text_back"))

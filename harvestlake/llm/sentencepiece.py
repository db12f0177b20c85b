"""SentencePiece encoding and decoding on the tokenizers library.

The model file is a protobuf message; the few fields needed are read from its wire format.
From them the same tokenizer is rebuilt: the normaliser (compiled character map, extra
spaces, leading space), the metaspace marker U+2581, the unigram lattice with its scores or
the BPE merges in the order of their scores, and byte fallback. Batches are encoded by the
library's threads; where words get their pieces independently of each other, each different word
is encoded once and the texts put together from them. The rebuilt tokenizer is checked against the SentencePiece library on
every text or on chosen ones, and the round trip on every text.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import TYPE_CHECKING

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from harvestlake.llm.common import free_name, small_batches, text_of

if TYPE_CHECKING:
    from tokenizers import Tokenizer

SPACE = "▁"
#: Characters of text given to the library at once; bounds what its encodings take. As many where only
#: different words go to it.
BATCH_CHARS, WORD_BATCH_CHARS = 400_000, 1_200_000
#: Characters of texts whose pieces a task remembers, for copies that follow.
REMEMBERED = 4_000_000
#: Words whose ids a process remembers before it forgets them all.
KNOWN_WORDS = 400_000
#: New words that are joined to one text, and that are encoded at once.
WORDS_A_TEXT, WORDS_AT_ONCE = 128, 50_000
#: Threads of one task.
THREADS = 2

# Fixed values of the public model format: field numbers and piece kinds.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes | float]]:
    """(number, value) of each field of a protobuf message."""
    at, end = 0, len(data)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < end:
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            size = varint()
            yield tag >> 3, data[at : at + size]
            at += size
        elif kind == 5:
            yield tag >> 3, struct.unpack("<f", data[at : at + 4])[0]
            at += 4
        elif kind == 1:
            yield tag >> 3, data[at : at + 8]
            at += 8
        else:
            raise ValueError(f"wire type {kind} is not part of a SentencePiece model")


@dataclass
class PieceModel:
    """What a SentencePiece model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        model = cls()
        for number, value in _fields(data):
            if number == PIECES:
                got = dict(_fields(value))
                model.pieces.append((got[1].decode("utf-8"), got.get(2, 0.0), got.get(3, NORMAL)))
            elif number == TRAINER:
                got = dict(_fields(value))
                model.kind = got.get(3, UNIGRAM)
                model.byte_fallback = bool(got.get(35, 0))
            elif number == NORMALIZER:
                got = dict(_fields(value))
                model.charsmap = got.get(2, b"")
                model.dummy_prefix = bool(got.get(3, 1))
                model.trim = bool(got.get(4, 1))
                model.escape = bool(got.get(5, 1))
        model.unk_id = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), 0)
        if model.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models can be rebuilt")
        return model

    def bytes_of(self, piece: str, kind: int) -> bytes:
        """What a piece stands for in a decoded text."""
        if kind == BYTE and self.byte_fallback:
            return bytes([int(piece[3:5], 16)])  # written <0x..>
        return (piece.replace(SPACE, " ") if self.escape else piece).encode("utf-8")

    @property
    def words_apart(self) -> bool:
        """Whether words get their pieces independently of each other, markers going with the word behind.

        So it is where texts are taken as they are, every piece is made by merges or bytes, and no
        piece has a marker behind anything but markers: then no merge joins a word and the next marker.
        """
        kinds = [kind for _, _, kind in self.pieces]
        normal = {p for p, _, kind in self.pieces if kind == NORMAL}
        joined = SPACE not in normal or any(SPACE in p.lstrip(SPACE) for p in normal)
        plain = not self.charsmap and not self.trim and self.dummy_prefix and self.escape
        whole = self.kind == BPE and self.byte_fallback and kinds.count(BYTE) == 256 and USER_DEFINED not in kinds
        return plain and whole and not joined

    def merges(self) -> list[tuple[str, str]]:
        """BPE merges: each piece's splits into two pieces, best piece first.

        The piece with the higher score merges first, so merges are ordered by the score of
        what they make; scores are distinct, and the splits of one piece make the same text.
        """
        rank = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind in (NORMAL, USER_DEFINED)}
        found = []
        for piece, score, kind in self.pieces:
            if kind not in (NORMAL, USER_DEFINED) or len(piece) < 2:
                continue
            splits = [
                (rank[piece[:k]], rank[piece[k:]], piece[:k], piece[k:])
                for k in range(1, len(piece))
                if piece[:k] in rank and piece[k:] in rank
            ]
            found += [(-score, rank[piece], left, right, a, b) for left, right, a, b in sorted(splits)]
        found.sort(key=lambda m: m[:4])
        return [(a, b) for *_, a, b in found]

    def build(self) -> Tokenizer:
        from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

        if self.kind == UNIGRAM:
            tokenizer = Tokenizer(
                models.Unigram([(p, s) for p, s, _ in self.pieces], self.unk_id, self.byte_fallback)
            )
        else:
            tokenizer = Tokenizer(
                models.BPE(
                    vocab={p: i for i, (p, _, _) in enumerate(self.pieces)},
                    merges=self.merges(),
                    unk_token=self.pieces[self.unk_id][0],
                    fuse_unk=True,
                    byte_fallback=self.byte_fallback,
                )
            )
        steps = []
        if self.charsmap:
            steps.append(normalizers.Precompiled(self.charsmap))
        if self.trim:
            steps += [normalizers.Replace(Regex(" +"), " "), normalizers.Replace(Regex("^ | $"), "")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(" "))
        if self.escape:
            steps.append(normalizers.Replace(" ", SPACE))
        tokenizer.normalizer = normalizers.Sequence(steps)
        undo = [decoders.Replace(SPACE, " ")] if self.escape else []
        if self.byte_fallback:
            undo.append(decoders.ByteFallback())
        undo.append(decoders.Fuse())
        if self.dummy_prefix:
            undo.append(decoders.Strip(" ", 1, 0))
        tokenizer.decoder = decoders.Sequence(undo)
        own = [AddedToken(p, normalized=False) for p, _, kind in self.pieces if kind == USER_DEFINED]
        if own:
            tokenizer.add_tokens(own)
        return tokenizer


class Codec:
    """The rebuilt tokenizer in one process."""

    def __init__(self, model: bytes, threads: int = THREADS):
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        self.data, self.threads = model, threads
        parsed = PieceModel.parse(model)
        self.tokenizer = parsed.build()
        self.dummy_prefix = parsed.dummy_prefix
        #: the bytes that each id stands for
        self.bytes = [parsed.bytes_of(p, kind) for p, _, kind in parsed.pieces]
        self._own = None
        self.words_apart = parsed.words_apart
        #: which ids begin with a marker, and the ids of words met so far, four bytes each
        self.begins = np.array([p.startswith(SPACE) for p, _, _ in parsed.pieces])
        self.words: dict[str, bytes] = {}

    def _packs_of(self, texts: list[str], most: int) -> Iterator[list[str]]:
        pack, chars = [], 0
        for text in texts:
            if pack and chars + len(text) > most:
                yield pack
                pack, chars = [], 0
            pack.append(text)
            chars += len(text)
        if pack:
            yield pack

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        yield from map(np.ndarray.tolist, self.encode_packed(texts))

    def encode_packed(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, four bytes each."""
        most, encode = (
            (WORD_BATCH_CHARS, self._encode_by_words) if self.words_apart else (BATCH_CHARS, self._encode_whole)
        )
        for pack in self._packs_of(texts, most):
            yield from encode(pack)

    def _encode_whole(self, texts: list[str]) -> Iterator[np.ndarray]:
        for encoding in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            yield np.array(encoding.ids, np.int32)

    def _encode_by_words(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Each different word of the texts is encoded once; texts with other markers than one between words go whole."""
        odd = {i for i, t in enumerate(texts) if not t or "  " in t or SPACE in t or t[0] == " " or t[-1] == " "}
        packs = self._packs_of([texts[i] for i in sorted(odd)], BATCH_CHARS)
        whole = (ids for pack in packs for ids in self._encode_whole(pack))
        parted = pc.split_pattern(pa.array([t for i, t in enumerate(texts) if i not in odd], pa.large_string()), " ")
        coded = parted.flatten().dictionary_encode()
        words, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        if len(self.words) > KNOWN_WORDS:
            self.words.clear()
        self._learn([w for w in words if w not in self.words])
        each = list(map(self.words.__getitem__, words))
        sizes = np.fromiter(map(len, each), np.int64, len(each)) // 4
        flat = np.frombuffer(b"".join(each), np.int32)
        # Where each word's ids stand in flat, and where they go.
        length = sizes[at]
        ends = np.cumsum(length)
        shift = (np.cumsum(sizes) - sizes)[at] - (ends - length)
        ids = flat[np.arange(length.sum()) + np.repeat(shift, length)]
        bounds = np.concatenate([[0], ends])[parted.offsets.to_numpy()].tolist()
        spans = zip(bounds, bounds[1:], strict=False)
        for i in range(len(texts)):
            if i in odd:
                yield next(whole)
            else:
                begin, end = next(spans)
                yield ids[begin:end]

    def _learn(self, new: list[str]) -> None:
        """Put the ids of the words into ``words``: joined to texts, whose ids are parted at the markers."""
        for lists in (new[k : k + WORDS_AT_ONCE] for k in range(0, len(new), WORDS_AT_ONCE)):
            parts = [lists[k : k + WORDS_A_TEXT] for k in range(0, len(lists), WORDS_A_TEXT)]
            for part, packed in zip(parts, self._encode_whole([" ".join(p) for p in parts]), strict=True):
                starts = (4 * np.flatnonzero(self.begins[packed])).tolist()
                data = packed.tobytes()
                for word, begin, end in zip(part, starts, [*starts[1:], len(data)], strict=True):
                    self.words[word] = data[begin:end]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)

    def round_trip(self, text: str, ids: list[int]) -> bool:
        """Whether the ids stand for the text's bytes: what ``decode`` asks, without making texts."""
        table = self.bytes
        back = b"".join([table[i] for i in ids])
        if self.dummy_prefix:
            back = back.removeprefix(b" ")
        return back == text.encode("utf-8")

    def same_as_library(self, text: str, ids: list[int]) -> bool:
        """Whether the SentencePiece library gives the same ids."""
        if self._own is None:
            import sentencepiece

            self._own = sentencepiece.SentencePieceProcessor(model_proto=self.data)
        return self._own.encode_as_ids(text) == ids


#: The codec of this worker process, which its tasks share; building the merges takes a while.
_codec: Codec | None = None


def codec_of(model: bytes, threads: int = THREADS) -> Codec:
    global _codec
    if _codec is None or (_codec.data, _codec.threads) != (model, threads):
        _codec = Codec(model, threads)
    return _codec


def encode_documents(
    docs: DataFrame,
    model_path: str,
    text: str = "text",
    threads: int = THREADS,
    verify_every: int = 1,
    pieces: str = "piece_ids",
    facts: str = "piece_facts",
) -> DataFrame:
    """``docs`` with ``piece_ids`` and ``piece_facts`` (n_pieces, round_trip, parity).

    Whole texts are encoded, without begin or end pieces; null and empty texts have no pieces.
    ``round_trip``: the ids stand for the text's bytes. ``parity``: the SentencePiece
    library gives the same ids; null where it was not asked. It is asked for every text whose
    hash is divisible by ``verify_every``. The model is read once on the driver and sent
    along; its size is that of its file. Other columns stay as they are.
    """
    with open(model_path, "rb") as file:
        data = file.read()
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(data)
    kind = T.StructType(
        [
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("n_pieces", T.LongType()),
            T.StructField("round_trip", T.BooleanType()),
            T.StructField("parity", T.BooleanType()),
        ]
    )

    arrow = to_arrow_type(kind)

    @F.arrow_udf(kind)
    def encoded(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        codec = codec_of(shared.value, threads)
        known, chars = {}, 0
        for column, asked in batches:
            texts = column.to_pylist()
            # Equal texts, also of earlier batches, are encoded and checked once.
            ask = {t: a for t, a in zip(texts, asked.to_pylist(), strict=True) if t not in known}
            for text, packed in zip(ask, codec.encode_packed(list(ask)), strict=True):
                ids = packed.tolist()
                parity = codec.same_as_library(text, ids) if ask[text] else None
                known[text] = (packed.copy(), codec.round_trip(text, ids), parity)
                chars += len(text)
            packs, round_trips, parities = zip(*[known[text] for text in texts], strict=True) if texts else ((), (), ())
            sizes = np.fromiter(map(len, packs), np.int64, len(packs))
            bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(bounds, np.concatenate(packs or [np.empty(0, np.int32)]))
            facts = [pa.array(sizes), pa.array(round_trips, pa.bool_()), pa.array(parities, pa.bool_())]
            yield pa.StructArray.from_arrays([ids, *facts], fields=list(arrow))
            if chars > REMEMBERED:
                known, chars = {}, 0

    done = free_name([*docs.columns, pieces, facts], "encoded")
    asked = F.pmod(F.xxhash64(text_of(text)), F.lit(verify_every)) == 0
    return (
        docs.withColumn(done, encoded(text_of(text), asked))
        .withColumn(pieces, F.col(f"{done}.ids"))
        .withColumn(facts, F.col(done).dropFields("ids"))
        .drop(done)
    )


def decode_documents(docs: DataFrame, model_path: str, pieces: str = "piece_ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text that the ids in ``pieces`` stand for; null ids give null."""
    with open(model_path, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    small_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = codec_of(shared.value)
        for ids in batches:
            known = [None if i is None else list(i) for i in ids]
            texts = iter(codec.decode([i for i in known if i is not None]))
            yield pd.Series([None if i is None else next(texts) for i in known], dtype="object")

    return docs.withColumn(text, decoded(F.col(f"`{pieces}`")))




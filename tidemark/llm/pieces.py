"""SentencePiece encoding and decoding on the tokenizers library, rebuilt from a model's protobuf."""

from __future__ import annotations

import os
import re
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ChunkCache

# Fixed values of the public SentencePiece model format: piece kinds, model kinds, the space marker.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
MARK = "▁"


def wire_fields(message: bytes):
    """(number, value) of each field of a protobuf message; length-delimited values stay bytes."""
    at, size = 0, len(message)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < size:
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        else:
            n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            value = message[at : at + n]
            at += n
        yield key >> 3, value


@dataclass
class PieceModel:
    """What a .model file says: pieces with scores and kinds, trainer and normaliser settings."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, raw: bytes) -> PieceModel:
        out = cls()
        for number, value in wire_fields(raw):
            if number == 1:
                f = dict(wire_fields(value))
                out.pieces.append((f.get(1, b"").decode(), struct.unpack("<f", f[2])[0] if 2 in f else 0.0, f.get(3, NORMAL)))
            elif number == 2:
                f = dict(wire_fields(value))
                out.kind, out.byte_fallback = f.get(3, UNIGRAM), bool(f.get(35, 0))
            elif number == 3:
                f = dict(wire_fields(value))
                out.charsmap = f.get(2, b"")
                out.dummy_prefix, out.squeeze, out.escape = (bool(f.get(k, 1)) for k in (3, 4, 5))
        if out.kind not in (UNIGRAM, BPE):
            raise ValueError(f"model kind {out.kind} is neither unigram nor BPE")
        return out

    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)


def normaliser(model: PieceModel, marker: bool = True):
    """The model's normaliser; without marker it stops before spaces become the metaspace marker."""
    from tokenizers import Regex, normalizers as N

    steps = [N.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [N.Replace(Regex(r"^ +| +$"), ""), N.Replace(Regex(" {2,}"), " ")]
    if marker:
        steps += [N.Prepend(MARK)] * model.dummy_prefix + [N.Replace(" ", MARK)] * model.escape
    return N.Sequence(steps)


def merges(model: PieceModel) -> list[tuple[str, str]]:
    """BPE merges in the order of the scores of what they make."""
    known = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for piece, i in known.items():
        found += [(-model.pieces[i][1], i, k, piece[:k], piece[k:]) for k in range(1, len(piece)) if piece[:k] in known and piece[k:] in known]
    return [(a, b) for _, _, _, a, b in sorted(found)]


def rebuild(model: PieceModel, whole: bool = True):
    """A tokenizers.Tokenizer for the model; with whole False it takes chunks whose spaces are markers already."""
    from tokenizers import Tokenizer, decoders as D, models as M

    if model.kind == UNIGRAM:
        core = M.Unigram([(p, s) for p, s, _ in model.pieces], unk_id=model.unknown(), byte_fallback=model.byte_fallback)
    else:
        core = M.BPE({p: i for i, (p, _, _) in enumerate(model.pieces)}, merges(model), unk_token=model.pieces[model.unknown()][0], fuse_unk=True, byte_fallback=model.byte_fallback)
    out = Tokenizer(core)
    if whole:
        out.normalizer = normaliser(model)
    strip = [D.Strip(" ", 1, 0)] if whole and model.dummy_prefix else []
    out.decoder = D.Sequence([D.Replace(MARK, " "), D.ByteFallback(), D.Fuse(), *strip])
    return out


class PieceCodec:
    """Encodes and decodes through chunks that no piece spans, each held against the reference library once.

    Where no piece has a marker behind another character, texts are cut before each run of spaces; a line
    feed that is in no piece is a chunk of its own. The ids are the rebuilt tokenizer's in any case; chunks
    whose ids differ from the reference's are remembered (BPE models that make one piece by several merges leave
    their order to position, as in long runs of one mark). Unigram models, and models whose pieces cross such
    cuts, are encoded whole.
    """

    def __init__(self, raw: bytes):
        import sentencepiece

        self.model = PieceModel.parse(raw)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.whole, self.part = rebuild(self.model), rebuild(self.model, whole=False)
        self.clean = normaliser(self.model, marker=False)
        self.plain = not self.model.charsmap and not self.model.squeeze
        texts = [p for p, _, kind in self.model.pieces if kind in (NORMAL, USER_DEFINED)]
        self.cuts = self.model.kind == BPE and self.model.escape and self.model.dummy_prefix and self.model.byte_fallback and not any(MARK in p.lstrip(MARK) or "\n" in p for p in texts)
        self.differ: set[str] = set()  # chunks whose ids the reference gives otherwise
        self.broken: set[str] = set()  # chunks that decoding doesn't give back
        self.feed = self.reference.encode("\n") if self.cuts else []
        find = re.compile(r" +[^ \n]*|[^ \n]+|\n").findall if self.cuts else (lambda t: [t])
        self.cache = ChunkCache(find, self._encode_many, 800_000 if self.cuts else 1)

    def _ids(self, chunks: list[str]) -> list[list[int]]:
        if not self.cuts:
            return [e.ids for e in self.whole.encode_batch_fast(chunks, add_special_tokens=False)]
        return [e.ids for e in self.part.encode_batch_fast([c.replace(" ", MARK) for c in chunks], add_special_tokens=False)]

    def _truth(self, chunks: list[str]) -> list[list[int]]:
        if not self.cuts:
            return self.reference.encode(chunks, num_threads=1)
        prefixed = [c[:1] == " " and c != " " for c in chunks]  # there the dummy prefix stands for the first space
        spaced = [c[1:] if p else "\n" + c for c, p in zip(chunks, prefixed, strict=True)]
        skip = [0 if p else len(self.feed) for p in prefixed]
        return [ids[k:] for ids, k in zip(self.reference.encode(spaced, num_threads=1), skip, strict=True)]

    def _encode_many(self, chunks: list[str]) -> list[bytes]:
        self.differ &= self.cache.known.keys()
        self.broken &= self.cache.known.keys()
        out = []
        own, told = self._ids(chunks), self._truth(chunks)
        back = (self.part if self.cuts else self.whole).decode_batch(own, skip_special_tokens=False)
        for chunk, ids, other, text in zip(chunks, own, told, back, strict=True):
            if ids != other:
                self.differ.add(chunk)
            if text != (chunk if self.cuts else self.clean.normalize_str(chunk)):
                self.broken.add(chunk)
            out.append(np.array(ids, "<u4").tobytes())
        return out

    def encode(self, texts: list[str]):
        """(ids as bytes, parity, round trip) of each text."""
        if self.cuts and not self.plain:
            texts = [self.clean.normalize_str(t) for t in texts]
        chunked = [" " + t if self.cuts and t else t for t in texts]
        for ids, text in zip(self.cache.encode(chunked), chunked, strict=True):
            bad = (self.differ or self.broken) and set(self.cache.find(text))
            yield ids if text else b"", not (bad and bad & self.differ), not (bad and bad & self.broken)


_codecs: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    if path not in _codecs:
        with open(path, "rb") as f:
            _codecs[path] = PieceCodec(f.read())
    return _codecs[path]


def encode_pieces(docs: DataFrame, model_path: str, threads: int = 2, text_col: str = "text", out_col: str = "pieces") -> DataFrame:
    """docs with out_col: struct<ids array<int>, ids_crc32, parity, round_trip>.

    ids are the rebuilt tokenizer's. parity: the reference library gives the same ids for every part of the
    text; round_trip: decoding gives the normalised text back. A null or empty text has no ids and both true.
    All other columns stay, one that is named out_col is replaced; an empty table stays empty. threads: of the
    library's batches in one task.
    """

    def made(texts: pa.Array) -> pa.Array:
        os.environ["TOKENIZERS_PARALLELISM"], os.environ["RAYON_NUM_THREADS"] = "true", str(threads)
        rows = list(codec(model_path).encode([t or "" for t in texts.to_pylist()]))
        flat = np.frombuffer(b"".join(r[0] for r in rows), "<u4").astype(np.int32)
        offsets = np.cumsum([0] + [len(r[0]) // 4 for r in rows]).astype(np.int32)
        return pa.StructArray.from_arrays(
            [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array([zlib.crc32(r[0]) for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.bool_()), pa.array([r[2] for r in rows], pa.bool_())],
            names=["ids", "ids_crc32", "parity", "round_trip"],
        )

    udf = F.arrow_udf(made, "struct<ids:array<int>,ids_crc32:bigint,parity:boolean,round_trip:boolean>")
    return docs.withColumn(out_col, udf(F.col(text_col)))


def decode_pieces(encoded: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """encoded with out_col: the normalised text of each array of ids; null gives null, no ids give ''."""

    def made(ids: pa.Array) -> pa.Array:
        return pa.array([None if x is None else codec(model_path).whole.decode(x, skip_special_tokens=False) for x in ids.to_pylist()], pa.string())

    return encoded.withColumn(out_col, F.arrow_udf(made, "string")(F.col(ids_col)))

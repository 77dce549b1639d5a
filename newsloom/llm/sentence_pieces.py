"""SentencePiece models run by the tokenizers library.

The model file is read field by field and rebuilt: normaliser, white-space marker,
unigram scores or merges, byte fallback. What the rebuilt model gives is compared with
the sentencepiece library wherever something is encoded for the first time.
"""

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from newsloom.llm.bpe_words import StretchEncoder
from newsloom.llm.workers import release, with_code

MARKER = "▁"
#: Fixed numbers of the model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message: numbers for varints, else bytes."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if byte < 0x80:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                if kind != 2:
                    raise ValueError(f"wire type {kind} in a model file")
                size, at = varint(at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


@dataclass
class Model:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trims: bool = True
    escapes: bool = True

    @property
    def unknown(self) -> int:
        return self.kinds.index(UNKNOWN)


def read_model(path: str) -> Model:
    model = Model()
    with open(path, "rb") as file:
        data = file.read()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            model.pieces.append(piece[1].decode())
            model.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            model.kinds.append(piece.get(3, NORMAL))
        elif number == 2:
            spec = dict(_fields(value))
            model.kind = spec.get(3, UNIGRAM)
            model.byte_fallback = bool(spec.get(35, 0))
            if spec.get(24, 0):
                raise ValueError("white space as a suffix is not supported")
        elif number == 3:
            spec = dict(_fields(value))
            model.charsmap = spec.get(2, b"")
            model.dummy_prefix, model.trims, model.escapes = (bool(spec.get(k, 1)) for k in (3, 4, 5))
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError(f"model kind {model.kind} is not supported")
    return model


def merges(model: Model) -> list[tuple[str, str]]:
    """Pairs that make up a piece, best piece first."""
    ids = {p: i for i, p in enumerate(model.pieces)}
    found = []
    for i, piece in enumerate(model.pieces):
        if model.kinds[i] == NORMAL:
            for k in range(1, len(piece)):
                left, right = ids.get(piece[:k]), ids.get(piece[k:])
                if left is not None and right is not None:
                    found.append((-model.scores[i], i, left, right))
    return [(model.pieces[a], model.pieces[b]) for _, _, a, b in sorted(found)]


def rebuild(model: Model, prefix: bool):
    """The model as a tokenizer; ``prefix``: put the marker before a text, as the model asks."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    if model.kind == UNIGRAM:
        vocabulary = list(zip(model.pieces, model.scores))
        core = models.Unigram(vocabulary, model.unknown, model.byte_fallback)
    else:
        core = models.BPE(
            {p: i for i, p in enumerate(model.pieces)},
            merges(model),
            unk_token=model.pieces[model.unknown],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    tokenizer = Tokenizer(core)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.trims:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if prefix and model.dummy_prefix:
        steps.append(normalizers.Prepend(MARKER if model.escapes else " "))
    if model.escapes:
        steps.append(normalizers.Replace(" ", MARKER))
    if steps:
        tokenizer.normalizer = normalizers.Sequence(steps)
    own = [p for p, k in zip(model.pieces, model.kinds) if k == USER_DEFINED]
    if own:
        tokenizer.add_tokens([AddedToken(p, normalized=True) for p in own])
    ends = [decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []
    tokenizer.decoder = decoders.Sequence(
        [decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse(), *ends]
    )
    return tokenizer


class PieceEncoder(StretchEncoder):
    """Ids of texts by the rebuilt model; ``differing`` counts stretches on which sentencepiece differs.

    Where it does, its ids are taken, unless ``parity`` is not asked for.

    Texts are cut before a blank that follows another character, and around line feeds,
    if no piece of the model goes across such a cut, so that the ids are those of the
    whole text; with a normaliser that changes texts they are not cut.
    """

    most = 250_000

    def __init__(self, path: str, threads: int = 2, parity: bool = True):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        self.model = read_model(path)
        plain = not self.model.charsmap and not self.model.trims and self.model.escapes
        pieces = [p for p, k in zip(self.model.pieces, self.model.kinds) if k in (NORMAL, USER_DEFINED)]
        within = any(MARKER in p.lstrip(MARKER) for p in pieces) or any(" " in p for p in pieces)
        self.cuts = plain and not within and USER_DEFINED not in self.model.kinds
        self.cuts_lines = self.cuts and self.model.byte_fallback and not any("\n" in p for p in pieces)
        self.prefixed = self.cuts and self.model.dummy_prefix
        self.tokenizer = rebuild(self.model, prefix=not self.prefixed)
        self.differing = 0
        self.peer = None
        if parity:
            import sentencepiece

            self.peer = sentencepiece.SentencePieceProcessor(model_file=path)
        # Only a lone line feed that is spelt in bytes is sure to be a token of its own.
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_id = line[0] if self.cuts_lines and len(line) == 1 else -1

    def prepare(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not self.prefixed:
            return data, offsets
        filled = np.diff(offsets) > 0
        data = np.insert(data, offsets[:-1][filled], np.uint8(0x20))
        return data, offsets + np.concatenate([[0], np.cumsum(filled)])

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(data)
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        if self.cuts and n > 1:
            blank = data == 0x20
            # 0x81 may end a marker that stands in the text itself.
            cut[1:n] |= blank[1:] & ~blank[:-1] & (data[:-1] != 0x81)
        if self.cuts_lines and n:
            line = data == 0x0A
            cut[:n] |= line
            cut[1:] |= line
        return np.flatnonzero(cut[:n])

    def encode_texts(self, texts: list[str]) -> list[list[int]]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if self.peer is None:
            return ids
        # Scores that nearly tie may be added up in another order; the library's ids count.
        theirs = self._by_peer(texts)
        self.differing += sum(a != b for a, b in zip(ids, theirs))
        return theirs

    def _by_peer(self, texts: list[str]) -> list[list[int]]:
        if not self.prefixed:
            return self.peer.encode(texts, num_threads=1)
        # The library puts the marker before a text itself: before a line feed, whose
        # ids are taken off again.
        skip = len(self.peer.encode("\n"))
        return [f[skip:] for f in self.peer.encode(["\n" + t for t in texts], num_threads=1)]


@lru_cache(maxsize=1)
def piece_encoder(path: str, threads: int, parity: bool) -> PieceEncoder:
    """One for each Python worker, so that its tasks share what it has learnt."""
    return PieceEncoder(path, threads, parity)


_SCHEMA = "ids array<int>, n_tokens bigint, decoded string, round_trip boolean, differing bigint"
_ADDED = ("ids", "n_tokens", "decoded", "round_trip", "differing")


def encode_and_decode(
    docs: DataFrame, model: str, text: str = "text", threads: int = 2, parity: bool = True
) -> DataFrame:
    """``docs`` with ``ids``, ``n_tokens``, the text ``decoded`` from them, ``round_trip`` and ``differing``.

    ``round_trip``: the decoded text is the text. ``differing``: stretches first met in
    this row's slice on which the sentencepiece library gives other ids than the rebuilt
    model (0: parity); ``ids`` are the library's then.
    NULL counts as the empty text: no ids, decoded to the empty text. Rows are
    independent; columns of the added names are replaced. ``model`` is a path that every
    executor can open.
    """
    kept = [c for c in docs.columns if c not in _ADDED or c == text]
    at = kept.index(text)
    ints = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_encoder(model, threads, parity)
        for batch in batches:
            for row, ids, lengths in coder.encode(batch.column(at)):
                differing, coder.differing = coder.differing, 0
                n = len(lengths)
                part = batch.slice(row, n)
                offsets = np.concatenate([[0], np.cumsum(lengths)])
                lists = [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
                decoded = coder.tokenizer.decode_batch(lists, skip_special_tokens=False)
                same = [d == (t or "") for d, t in zip(decoded, part.column(at).to_pylist())]
                added = [
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32)), type=ints),
                    pa.array(lengths.astype(np.int64)),
                    pa.array(decoded, pa.string()),
                    pa.array(same, pa.bool_()),
                    pa.array([differing] * n, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], [*kept, *_ADDED])
        release()

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema]
    return with_code(docs.select(*kept)).mapInArrow(run, ", ".join([*fields, _SCHEMA]))

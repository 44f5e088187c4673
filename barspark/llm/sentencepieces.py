"""SentencePiece models on the tokenizers library.

The model file's protobuf is read field by field; from it come the
normaliser (character map, extra white space, dummy prefix), the marker for
spaces, the pieces with their scores (unigram models as they are, pair
models as merges ranked by score), and byte fallback.  Batches are
encoded by the library's threads, each distinct word once where the model
allows it (``Units``).  Encoded results can be verified against the
sentencepiece library, which encodes every whole text.

The model's bytes are read once on the driver and travel with the tasks (a
model is bounded: files above ``MOST_BYTES`` are refused).

Edge cases: a null text is treated as empty and has no tokens; texts of any length are
encoded whole; words that occur in no piece fall back to bytes, or to the
unknown piece if the model has no bytes; repeated rows get equal results; the strings of control pieces in a
text are ordinary text.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
MOST_BYTES = 64 << 20
#: Texts that the tokenizer encodes at a time, joined units or whole ones; the reference library takes eight times as many.
AT_ONCE = 16
# Fixed values of the model file's format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def fields(data: bytes):
    """(number, value) of a protobuf message: integers, 4- and 8-byte values and byte strings."""
    at, n = 0, len(data)

    def varint():
        nonlocal at
        shift = value = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < n:
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        elif kind == 2:
            size = varint()
            value = data[at:at + size]
            at += size
        else:
            size = 8 if kind == 1 else 4
            value = data[at:at + size]
            at += size
        yield key >> 3, value


def read_model(data: bytes) -> dict:
    """Pieces (text, score, type) and the settings that encoding depends on."""
    m = {"pieces": [], "type": UNIGRAM, "byte_fallback": False, "unk": 0, "charsmap": b"", "prefix": True,
         "extra": True, "escape": True}
    for number, value in fields(data):
        if number == 1:
            piece = {1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(fields(value))
            m["pieces"].append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
        elif number == 2:
            t = dict(fields(value))
            m["type"], m["byte_fallback"], m["unk"] = t.get(3, UNIGRAM), bool(t.get(35, 0)), t.get(40, 0)
        elif number == 3:
            t = dict(fields(value))
            m["charsmap"] = t.get(2, b"")
            m["prefix"], m["extra"], m["escape"] = (bool(t.get(k, 1)) for k in (3, 4, 5))
    return m


def build(model: dict, distinct: bool = False):
    """The tokenizers pipeline of a model; ``distinct``: for distinct plain words between single spaces, so it keeps none for later."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    pieces = model["pieces"]
    unk = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), model["unk"])
    if model["type"] == UNIGRAM:
        low = min((s for _, s, t in pieces if t == NORMAL), default=0.0)
        # pieces that no text may match keep their place and get a score that none would choose
        vocab = [(p, s if t in (NORMAL, USER) else low - 1e4) for p, s, t in pieces]
        core = models.Unigram(vocab, unk, model["byte_fallback"])
    elif model["type"] == BPE:
        ids = {p: i for i, (p, _, _) in enumerate(pieces)}
        usable = {p: s for p, s, t in pieces if t in (NORMAL, USER)}
        merges = []
        for p, s in usable.items():
            for i in range(1, len(p)):
                if p[:i] in usable and p[i:] in usable:
                    merges.append((-s, ids[p], i, p[:i], p[i:]))
        merges.sort()
        core = models.BPE(ids, [(x[3], x[4]) for x in merges], unk_token=pieces[unk][0], fuse_unk=True,
                          byte_fallback=model["byte_fallback"], cache_capacity=0 if distinct else 10_000)
    else:
        raise ValueError("only unigram and pair models are supported")
    t = Tokenizer(core)
    if distinct and not model["charsmap"] and model["prefix"] and model["escape"]:
        # such words are left as they are but for the markers; extra white space, they have none
        t.pre_tokenizer = pre_tokenizers.Metaspace(MARK, "always", split=True)
        return t
    steps = []
    if model["charsmap"]:
        steps.append(normalizers.Precompiled(model["charsmap"]))
    if model["extra"]:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model["prefix"]:
        steps.append(normalizers.Prepend(" "))
    if model["escape"]:
        steps.append(normalizers.Replace(" ", MARK))
    t.normalizer = normalizers.Sequence(steps)
    if model["type"] == BPE and not any(MARK in p.lstrip(MARK) for p, _, k in pieces if k in (NORMAL, USER)):
        # no piece holds a marker after another character, so none reaches across such a place: cut there
        t.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    after = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model["prefix"]:
        after.append(decoders.Strip(" ", 1, 0))
    t.decoder = decoders.Sequence(after)
    return t


def load(path: str) -> bytes:
    data = open(path, "rb").read()
    if len(data) > MOST_BYTES:
        raise ValueError(f"{path} has {len(data)} bytes; models above {MOST_BYTES} do not travel with tasks")
    return data


class Units:
    """Encoding and decoding by the units that the tokenizer cuts a text into (a word with the marker before it).

    No piece reaches across units, so a text's ids are those of its units one
    after the other and decoding goes unit by unit.  Distinct new units are joined
    to texts and encoded together (by ``distinct``, a tokenizer that stores no words, if given); where a unit's ids
    begin is seen by their markers.  Ids are kept in one growing array (up to ``most`` units, then afresh, and cleared
    when a task ends).  The library's encodings take far more memory than the ids: those of ``AT_ONCE`` joined texts
    exist at a time.  Ids whose pieces spell their text are not decoded by the library, all others are.
    Texts that are not plain words between single spaces, and models whose
    pieces may hold a marker inside, are encoded whole.
    """

    def __init__(self, tokenizer, most: int = 300_000, joined: int = 2_000, distinct=None):
        self.tokenizer, self.most, self.joined, self.distinct = tokenizer, most, joined, distinct
        vocab = tokenizer.get_vocab(with_added_tokens=False)
        self.begins = np.zeros(max(vocab.values()) + 1, bool)
        self.begins[[i for p, i in vocab.items() if p.startswith(MARK)]] = True
        spelled = [b""] * len(self.begins)
        for p, i in vocab.items():
            byte = re.fullmatch("<0x([0-9A-Fa-f]{2})>", p)
            spelled[i] = bytes([int(byte[1], 16)]) if byte else p.replace(MARK, " ").encode()
        self.spelled = pa.array(spelled, pa.binary())
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)
        self.changed: dict[int, str] = {}  # units that decoding does not give again, by number

    def _decode(self, ids: np.ndarray, text: str) -> str:
        """What the ids decode to: ``text``, if a space (which decoding takes off) and the text is what the pieces spell one
        after the other.  As pieces of characters are whole, bytes between them in a text of characters are, too."""
        if len(ids):
            _, offsets, data = self.spelled.take(pa.array(ids)).buffers()
            first, end = np.frombuffer(offsets, np.int32, len(ids) + 1)[[0, -1]].tolist()
            # a model that puts no space before a text spells none there, and is decoded by the library
            if data.slice(first, end - first).equals(pa.py_buffer(b" " + text.encode())):
                return text
        return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)

    def whole(self, texts: list[str], tokenizer=None) -> tuple[list[np.ndarray], list[str]]:
        out, back = [], []
        for i in range(0, len(texts), AT_ONCE):
            few = texts[i:i + AT_ONCE]
            ids = [np.array(e.ids, np.int32) for e in (tokenizer or self.tokenizer).encode_batch_fast(few, add_special_tokens=False)]
            out += ids
            back += map(self._decode, ids, few)
        return out, back

    def _learn(self, new: list[str]) -> None:
        parts = [new[i:i + self.joined] for i in range(0, len(new), self.joined)]
        few = (self.whole([" ".join(p) for p in parts[i:i + AT_ONCE]], self.distinct) for i in range(0, len(parts), AT_ONCE))
        found = [self.ids]
        ends = [self.ends]
        base, n = int(self.ends[-1]), len(self.place)
        for part, (x, text) in zip(parts, (y for ids, back in few for y in zip(ids, back))):
            first, again = np.flatnonzero(self.begins[x]), text.split(" ")
            if len(first) != len(part) or len(again) != len(part) or first[0]:
                one, again = self.whole(part)  # a unit at a time
                x = np.concatenate(one)
                end = np.cumsum([len(y) for y in one])
            else:
                end = np.append(first[1:], len(x))
            if again != part:
                self.changed.update((n + i, b) for i, (a, b) in enumerate(zip(part, again)) if a != b)
            self.place.update(zip(part, range(n, n + len(part))))
            found.append(x)
            ends.append(base + end)
            base, n = base + len(x), n + len(part)
        self.ids, self.ends = np.concatenate(found), np.concatenate(ends)

    def encode(self, texts: pa.Array) -> tuple[list[np.ndarray], list[str]]:
        """Ids and decoded text of every text."""
        if self.tokenizer.pre_tokenizer is None:
            return self.whole(texts.to_pylist())
        odd = pc.equal(pc.binary_length(texts), 0)
        for test, pattern in ((pc.match_substring, MARK), (pc.match_substring, "  "), (pc.starts_with, " "), (pc.ends_with, " ")):
            odd = pc.or_(odd, test(texts, pattern))
        rest = iter(zip(*self.whole(texts.filter(odd).to_pylist())) if odd.true_count else ())
        words = pc.split_pattern(texts.filter(pc.invert(odd)), " ")
        first = words.offsets.to_numpy()
        words = words.values.slice(first[0], first[-1] - first[0]).dictionary_encode()
        first = first - first[0]
        distinct = words.dictionary.to_pylist()
        if len(self.place) > self.most:
            self.clear()
        number = np.fromiter(map(self.place.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = np.arange(len(self.place), len(self.place) + len(new))
            self._learn([distinct[i] for i in new.tolist()])
        at = number[words.indices.to_numpy()]
        size = self.ends[at + 1] - self.ends[at]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(self.ends[at] - upto[:-1], size) + np.arange(upto[-1])]
        altered = np.isin(at, list(self.changed)) if self.changed else np.zeros(len(at), bool)
        out_ids, out_back, k = [], [], 0
        for text, whole in zip(texts.to_pylist(), odd.to_pylist()):
            if whole:
                one, text = next(rest)
            else:
                here = slice(first[k], first[k + 1])
                one, k = ids[upto[here.start]:upto[here.stop]], k + 1
                if altered[here].any():
                    text = " ".join(self.changed.get(i, w) for i, w in zip(at[here].tolist(), text.split(" ")))
            out_ids.append(one)
            out_back.append(text)
        return out_ids, out_back


@lru_cache(maxsize=2)
def _tools(data: bytes, verify: bool):
    """A model's units and, to verify, the reference library's processor: built once per worker, kept for its later tasks."""
    sp = None
    if verify:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=data)
    model = read_model(data)
    tokenizer = build(model)
    return Units(tokenizer, distinct=build(model, distinct=True) if tokenizer.pre_tokenizer else None), sp


def _encode(data: bytes, threads: int, verify: bool, ids_out: bool, batch_chars: int = 1_000_000):
    def run(it):
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        units, sp = _tools(data, verify)
        try:
            for batch in it:
                column, first = batch.column("text"), 0
                lengths = pc.binary_length(column).to_numpy(zero_copy_only=False)
                while first < len(lengths):
                    end, n = first, 0
                    while end < len(lengths) and (end == first or n + lengths[end] <= batch_chars):
                        n += lengths[end]
                        end += 1
                    ids, back = units.encode(column.slice(first, end - first))
                    part = column.slice(first, end - first).to_pylist()
                    cols = [batch.column("doc_id").slice(first, end - first), pa.array([len(x) for x in ids], pa.int64()),
                            pa.array([hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in ids]),
                            pa.array([a == b for a, b in zip(back, part)], pa.bool_())]
                    names = ["doc_id", "n_tokens", "ids_sha256", "round_trip"]
                    if sp:
                        same = [np.array_equal(a, b) for i in range(0, len(part), 8 * AT_ONCE) for a, b in
                                zip(ids[i:i + 8 * AT_ONCE], sp.encode(part[i:i + 8 * AT_ONCE], out_type="numpy", num_threads=threads))]
                        cols.append(pa.array(same, pa.bool_()))
                        names.append("parity")
                    if ids_out:
                        offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                        cols += [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids), pa.int32())), pa.array(back, pa.string())]
                        names += ["ids", "decoded"]
                    yield pa.RecordBatch.from_arrays(cols, names)
                    first = end
        finally:  # the worker outlives the task, beside those of other stages
            units.clear()
            pa.default_memory_pool().release_unused()
    return run


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", threads: int = 2,
           verify: bool = True, ids: bool = True) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256 (of the ids as 32-bit little-endian numbers), round_trip
    (decoding gives the text again), parity (the sentencepiece library gives the same ids) where ``verify``,
    and ids and decoded where ``ids``."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, round_trip boolean"
    schema += ", parity boolean" * verify + ", ids array<int>, decoded string" * ids
    return d.mapInArrow(_encode(load(model_path), threads, verify, ids), schema)

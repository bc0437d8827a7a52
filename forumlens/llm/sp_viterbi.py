"""SentencePiece encoding and decoding by Viterbi over a shared trie of words.

Spaces become the mark U+2581 and one is put before the text, as the model file
asks.  No piece of the vocabulary goes on past a mark or a line feed, so a text
falls into marked words whose best segmentations are independent.  A task
collects the distinct marked words of its rows, sorts them and walks them depth
first: sorted neighbours are paths of a trie, and the forward scores of the
prefix a word shares with the one before are kept, only the rest is computed.

A piece's score is its log-probability.  A file of merge ranks (a BPE model, with
scores 0, -1, -2, ...) has none; its pieces then get Zipf's law over the rank,
-ln(rank + 2).  Characters without a piece are written as byte pieces.

Decoding joins pieces, turns marks into spaces and drops the first one; a mark
that the text itself contains is written in bytes, so every text comes back.

Defined cases: a null text has null ids, an empty text has no ids, repeated rows
are encoded alike, an empty table gives no rows; rows need not have distinct or
non-null ids.  Only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CACHE = 400_000          # distinct words a task remembers
WORDS = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


class Vocabulary:
    """Pieces, scores and byte pieces of a model file; plain data, so it ships to tasks."""

    def __init__(self, path: str = MODEL):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        self.special = {i for i in range(self.size) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(self.size) if sp.is_byte(i)}
        plain = [i for i in range(self.size) if i not in self.special and not sp.is_byte(i)]
        raw = [sp.get_score(i) for i in plain]
        ranks = raw == [-float(i) for i in range(len(raw))]
        self.score = {sp.id_to_piece(i): (-math.log(r + 2) if ranks else s, i) for r, (i, s) in
                      enumerate(zip(plain, raw))}
        for p in self.score:
            if re.search(f"[^{MARK}]{MARK}", p) or ("\n" in p and p != "\n"):
                raise ValueError(f"piece {p!r} crosses a word border")
        # Every suffix of a piece, so that a search backwards stops early; a suffix
        # that is no piece itself has no score.
        self.tail = {p[i:]: (-math.inf, -1) for p in self.score for i in range(len(p))} | self.score
        # Below every path of known pieces, so bytes are a last resort.
        self.byte_score = min((s for s, _ in self.score.values()), default=0.0) - 10.0
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte pieces")

    def byte_ids(self, ch: str) -> list[int]:
        return [self.bytes[b] for b in ch.encode("utf-8", "surrogatepass")]


def segment(words: list[str], vocab: Vocabulary) -> dict[str, tuple[int, ...]]:
    """Best pieces of each word; ``words`` may come in any order."""
    tail, low, out = vocab.tail.get, -math.inf, {}
    best, frm, pid, before = [0.0], [0], [-1], ""
    for w in sorted(set(words)):
        size, had = len(w), len(before)
        same, most = 0, size if size < had else had
        while same < most and w[same] == before[same]:
            same += 1
        del best[same + 1:], frm[same + 1:], pid[same + 1:]
        for end in range(same + 1, size + 1):
            at = a = end - 1
            top, piece = low, -1
            hit = tail(w[a])
            if hit is None or hit[1] < 0:
                # A character without a piece of its own may be written in bytes.
                top = best[a] + vocab.byte_score * len(w[a].encode("utf-8", "surrogatepass"))
            while hit:
                s = best[a] + hit[0]
                if s > top:
                    top, at, piece = s, a, hit[1]
                if not a:
                    break
                a -= 1
                hit = tail(w[a:end])
            best.append(top)
            frm.append(at)
            pid.append(piece)
        ids, at = [], size
        while at:
            a, piece = frm[at], pid[at]
            if piece < 0:
                ids += vocab.byte_ids(w[a:at])[::-1]
            else:
                ids.append(piece)
            at = a
        ids.reverse()
        out[w], before = tuple(ids), w       # tuples of ints cost the garbage collector nothing
    return out


def _words(marked: str) -> list[str]:
    """Marked words of a text whose spaces are marks already."""
    if MARK + MARK in marked:
        return WORDS.findall(marked)
    return marked.replace(MARK, " " + MARK).replace("\n", " \n ").split(" ")     # with some empty strings


def marked_words(text: str) -> list[str]:
    """Marked words of a text without marks of its own."""
    return [w for w in _words(MARK + text.replace(" ", MARK)) if w] if text else []


def encode_texts(texts: list[str | None], vocab: Vocabulary, known: dict[str, list[int]]) -> list[list[int] | None]:
    """Ids of each text; ``known`` keeps words from call to call."""
    parts: list = []
    seen: set[str] = set()
    own = vocab.byte_ids(MARK)
    for t in texts:
        if not t:
            parts.append(t if t is None else [])
            continue
        if MARK in t:            # marks of the text itself are written in bytes
            first, *rest = t.split(MARK)
            ws = [*_words(MARK + first.replace(" ", MARK))]
            for p in rest:
                ws += [own, *_words(p.replace(" ", MARK))]
            seen.update(w for w in ws if w is not own)
        else:
            ws = _words(MARK + t.replace(" ", MARK))
            seen.update(ws)
        parts.append(ws)
    known.update(segment([w for w in seen if w not in known], vocab))
    get = known.__getitem__
    return [ws if ws is None else list(chain.from_iterable(
        map(get, ws) if own not in ws else (w if w is own else get(w) for w in ws))) for ws in parts]


def decode_ids(ids: list[int], piece: list[str | None], byte_of: dict[int, int]) -> str:
    """The text of ids; ``piece`` is by id, None for special ids and bytes from 128."""
    try:
        text = "".join(map(piece.__getitem__, ids))
    except TypeError:
        out, run = [], bytearray()
        for i in ids:
            if piece[i] is None:
                if i in byte_of:
                    run.append(byte_of[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace").replace(MARK, "\0" + MARK))
                run = bytearray()
            out.append(piece[i].replace("\0", "\0\0"))
        if run:
            out.append(run.decode("utf-8", "replace").replace(MARK, "\0" + MARK))
        # A mark behind an odd zero came from bytes and is the text's own.
        text = "".join(out)
        text = re.sub(f"\0(\0|{MARK})|{MARK}", lambda m: m[1] or " ", text)
        return text[1:] if text.startswith(" ") else text
    text = text.replace(MARK, " ")
    return text[1:] if text.startswith(" ") else text


def _tables(vocab: Vocabulary) -> tuple[list[str | None], dict[int, int]]:
    piece: list[str | None] = [None] * vocab.size
    for p, (_, i) in vocab.score.items():
        piece[i] = p
    for b in range(128):         # a byte below 128 is a character by itself
        piece[vocab.bytes[b]] = chr(b)
    return piece, {i: b for b, i in vocab.bytes.items()}


def encode(docs: DataFrame, vocab: Vocabulary, key: str = "doc_id", text: str = "text",
           check: bool = False) -> DataFrame:
    """``key``, ``ids`` and, with ``check``, whether decoding them gives the text again."""
    light = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[int]] = {}
        piece, byte_of = _tables(vocab)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                texts = part.column(1).to_pylist()
                if len(known) > CACHE:
                    known.clear()
                got = encode_texts(texts, vocab, known)
                lens = np.array([len(x) if x is not None else 0 for x in got])
                flat = np.fromiter((i for x in got if x is not None for i in x), np.int32, int(lens.sum()))
                offsets = pa.array(np.concatenate(([0], np.cumsum(lens))).astype(np.int32))
                ids = pa.ListArray.from_arrays(offsets, pa.array(flat), mask=pa.array([x is None for x in got]))
                cols = [part.column(0), ids]
                if check:
                    ok = [None if t is None else decode_ids(x, piece, byte_of) == t for t, x in zip(texts, got)]
                    cols.append(pa.array(ok, pa.bool_()))
                yield pa.RecordBatch.from_arrays(cols, ["key", "ids", "round_trip"][:len(cols)])

    kind = light.schema["key"].dataType.simpleString()
    out = light.mapInArrow(run, f"key {kind}, ids array<int>" + (", round_trip boolean" if check else ""))
    return out.withColumnRenamed("key", key)


def decode(encoded: DataFrame, vocab: Vocabulary, key: str = "doc_id") -> DataFrame:
    """``key`` and ``text`` of rows with ``ids``."""
    light = encoded.select(F.col(f"`{key}`").alias("key"), "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, byte_of = _tables(vocab)
        for b in batches:
            texts = [None if x is None else decode_ids(x, piece, byte_of) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["key", "text"])

    kind = light.schema["key"].dataType.simpleString()
    return light.mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)

"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

A text is cut before each run of word marks; no piece of such a model crosses
that border, so words are encoded one by one and only words not met before in
the task are worked on.  All new words lie in one flat symbol array.  Each round
finds every word's best pair rank (segmented minimum), merges its occurrences
from the left, all words at once, and compacts; a word stops its round at an
occurrence whose merged piece forms a pair of equal or better rank with a
neighbour, as that pair then comes first.  The result equals the library's.

Defined cases: a null or empty text gives begin and end ids only and decodes to
an empty text; characters outside the vocabulary become byte pieces; of pairs
that tie the leftmost merges first; texts may be of any length; repeated rows
change nothing; an empty table gives an empty result; columns of the input whose
names are added stay under that name and an underscore.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import aside, small_batches

MARK = "▁"
#: Words kept between batches of a task, and the longest of them in characters; the memory bound of the cache, not of the input.
CACHE, LONGEST = 1 << 18, 64
NONE = np.int64(1 << 40)


class Model:
    """Tables of one model file: ids, ranks and the sorted keys of all pairs that merge."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb

        m = pb.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        spec = m.normalizer_spec
        if m.trainer_spec.model_type != 2 or not m.trainer_spec.byte_fallback or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or not spec.escape_whitespaces or m.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only BPE models with byte fallback, a dummy prefix and no normalisation are supported")
        kinds = m.SentencePiece.Type
        self.begin, self.end = m.trainer_spec.bos_id, m.trainer_spec.eos_id
        self.byte_ids = np.array([i for i, p in enumerate(m.pieces) if p.type == kinds.BYTE], np.uint32)
        self.id = {p.piece: i for i, p in enumerate(m.pieces) if p.type == kinds.NORMAL}
        if any(MARK in p.lstrip(MARK) or (p[:2] == MARK * 2 and p.strip(MARK)) for p in self.id) or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in m.pieces):
            raise ValueError("a piece crosses a word border")
        ranks = {s: r for r, s in enumerate(sorted({p.score for p in m.pieces}, reverse=True))}
        self.rank = np.array([ranks[p.score] for p in m.pieces], np.int64)
        self.scale = np.int64(len(m.pieces) + 1)
        pairs = {}
        for p, i in self.id.items():
            for k in range(1, len(p)):
                a, b = self.id.get(p[:k]), self.id.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * int(self.scale) + b] = i
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.runs: dict[int, list[int]] = {}
        self.one = np.array([self.id[MARK]], "<u4").tobytes()
        #: Bytes of each id when decoded; control pieces vanish, byte pieces are raw.
        self.bytes = [b"" if p.type == kinds.CONTROL else b" \xe2\x81\x87 " if p.type == kinds.UNKNOWN else bytes([int(p.piece[3:5], 16)]) if p.type == kinds.BYTE else p.piece.replace(MARK, " ").encode() for p in m.pieces]

    def pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged piece and rank of each pair; -1 and NONE where it doesn't merge."""
        key = a * self.scale + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (a >= 0) & (b >= 0)
        piece = np.where(hit, self.merged[at], -1)
        return piece, np.where(hit, self.rank[piece], NONE)

    def marks(self, n: int) -> list[int]:
        """Ids of a run of n marks: all its pairs have one rank, so merges go from the left."""
        if n not in self.runs:
            stack: list[int] = []
            for _ in range(n):
                stack.append(1)
                while len(stack) > 1 and MARK * (stack[-2] + stack[-1]) in self.id:
                    stack.append(stack.pop() + stack.pop())
            self.runs[n] = [self.id[MARK * k] for k in stack]
        return self.runs[n]

    def words(self, words: list[str]) -> tuple[bytes, list[int]]:
        """Ids of all words as little-endian 32-bit integers, one after the other, and the byte at which each ends.

        While merging, a character outside the vocabulary is the negative of its code point, less one."""
        size = np.array([len(w) for w in words])
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        chars = np.flatnonzero(np.bincount(points))
        of = np.zeros(chars[-1] + 1 if len(chars) else 1, np.int64)
        of[chars] = [self.id.get(chr(c), -c - 1) for c in chars.tolist()]
        sym = of[points]
        word = np.repeat(np.arange(len(words)), size)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        piece, rank = self.pair(sym, np.append(sym[1:], -1))
        rank[np.append(word[1:] != word[:-1], True)] = NONE
        while len(sym):
            start = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.repeat(np.minimum.reduceat(rank, start), np.diff(np.append(start, len(sym))))
            # words without a pair are ready
            ready = best == NONE
            if ready.any():
                done.append((word[ready], sym[ready]))
                keep = ~ready
                sym, word, piece, rank, best = sym[keep], word[keep], piece[keep], rank[keep], best[keep]
                if not len(sym):
                    break
            hit = rank == best
            # of overlapping occurrences, every other one from the left
            index = np.arange(len(sym))
            opens = hit & ~np.concatenate(([False], hit[:-1]))
            since = index - np.maximum.accumulate(np.where(opens, index, 0))
            hit &= since % 2 == 0
            at = np.flatnonzero(hit)
            p, mine = piece[at], best[at]
            prev = np.where(at > 0, sym[at - 1], -1)
            prev[(at > 0) & (word[at - 1] != word[at])] = -1
            joined = np.concatenate(([False], (at[1:] - at[:-1] == 2) & (word[at[1:]] == word[at[:-1]])))
            prev = np.where(joined, np.concatenate(([-1], p[:-1])), prev)
            after = np.minimum(at + 2, len(sym) - 1)
            nxt = np.where((at + 2 < len(sym)) & (word[after] == word[at]), sym[after], -1)
            stop = (self.pair(prev, p)[1] <= mine) | (self.pair(p, nxt)[1] <= mine)
            # up to the first such occurrence of its word
            begun = np.cumsum(stop) - stop
            first = np.concatenate(([True], word[at[1:]] != word[at[:-1]]))
            base = np.maximum.accumulate(np.where(first, begun, 0))
            at, p = at[begun == base], p[begun == base]
            sym[at] = p
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            at -= np.arange(len(at))  # each occurrence before it has taken one place
            sym, word, piece, rank = sym[keep], word[keep], piece[keep], rank[keep]
            # only pairs beside a merged piece are new
            near = np.zeros(len(sym), bool)
            near[at] = near[at[at > 0] - 1] = True
            at = np.flatnonzero(near)
            after = np.minimum(at + 1, len(sym) - 1)
            piece[at], new = self.pair(sym[at], np.where(at + 1 < len(sym), sym[after], -1))
            rank[at] = np.where((at + 1 < len(sym)) & (word[after] == word[at]), new, NONE)
        word, sym = (np.concatenate(x) if done else np.empty(0, np.int64) for x in (zip(*done, strict=True) if done else ((), ())))
        order = np.argsort(word, kind="stable")
        word, sym = word[order], sym[order]
        if (strange := sym < 0).any():  # byte pieces
            spelled = {x: self.byte_ids[list(chr(-x - 1).encode("utf-8", "surrogatepass"))] for x in np.unique(sym[strange]).tolist()}
            at = np.flatnonzero(strange)
            each = np.ones(len(sym), np.int64)
            each[at] = [len(spelled[x]) for x in sym[at].tolist()]
            begin = np.cumsum(each) - each
            word, flat = np.repeat(word, each), np.repeat(sym, each)
            for i, x in zip(begin[at].tolist(), sym[at].tolist(), strict=True):
                flat[i : i + len(spelled[x])] = spelled[x]
            sym = flat
        return sym.astype("<u4").tobytes(), (4 * np.cumsum(np.bincount(word, minlength=len(words)))).tolist()


WORD = re.compile(f"{MARK}*[^{MARK}]*")


class Coder:
    """Encodes and decodes batches of texts; holds the cache of a task."""

    def __init__(self, path: str) -> None:
        self.model, self.cache = Model(path), {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian 32-bit integers, begin and end ids included."""
        m, cache = self.model, self.cache
        if len(cache) > CACHE:
            cache.clear()
        cut = [WORD.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = [w for w in set().union(*cut) if w not in cache]
        plain = [w for w in new if w[1:2] != MARK and w != MARK]
        if plain:
            flat, ends = m.words(plain)
            cache.update(zip(plain, [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))
        several = [(w, w.lstrip(MARK)) for w in new if w not in cache]
        if several:  # the last mark of a run belongs to the word; if it stays alone there, it merges with the others
            flat, ends = m.words([MARK + bare for _, bare in several])
            for (w, bare), a, b in zip(several, [0, *ends], ends, strict=False):
                own = flat[a:b] if bare else b""
                lone = own[:4] == m.one
                marks = len(w) - len(bare) - (bool(bare) and not lone)
                cache[w] = np.array(m.marks(marks), "<u4").tobytes() + own[4 * lone :]
        begin, end = (np.array([x], "<u4").tobytes() for x in (m.begin, m.end))
        out = [begin + b"".join([cache[w] for w in x]) + end for x in cut]
        for w in new:
            if len(w) > LONGEST:
                del cache[w]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The library's decode(ids): control pieces vanish, the dummy prefix goes, wrong bytes become U+FFFD."""
        table = self.model.bytes
        whole = b"".join([table[i] for i in ids.tolist()])
        text = decoded(whole)
        return text[1:] if text[:1] == " " else text


def decoded(raw: bytes) -> str:
    """UTF-8, each byte that is no part of a character as U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return "".join(x if len(x) else "" for x in pieces(raw))


def pieces(raw: bytes) -> Iterator[str]:
    while raw:
        try:
            yield raw.decode()
            return
        except UnicodeDecodeError as e:
            yield raw[: e.start].decode() + "�"
            raw = raw[e.start + 1 :]


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """docs with ids_col (array<int>) added: the ids of each text."""
    docs, names = aside(docs, [ids_col])
    schema, kept, text_col = docs.schema, docs.columns, names[text_col]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(model_path)
        for part in parts:
            found = coder.encode([x.as_py() or "" for x in part.column(part.schema.get_field_index(text_col))])
            ends = np.cumsum([0] + [len(x) // 4 for x in found])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4")))
            yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in kept), ids], [*kept, ids_col])

    small_batches(docs.sparkSession)
    out = T.StructType([*(f for f in schema if f.name in kept), T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(run, out)


def decode(coded: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """coded with text_col added: the text that its ids spell; null ids give an empty text."""
    coded, names = aside(coded, [text_col])
    kept, ids_col = coded.columns, names[ids_col]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(model_path)
        for part in parts:
            ids = part.column(part.schema.get_field_index(ids_col))
            found = [coder.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else "" for x in ids]
            yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in kept), pa.array(found, pa.string())], [*kept, text_col])

    small_batches(coded.sparkSession)
    return coded.mapInArrow(run, T.StructType([*(f for f in coded.schema if f.name in kept), T.StructField(text_col, T.StringType())]))


def round_trip(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """docs with ids_col and decoded_col in place of the text: encoded, then decoded from the ids, by one Python worker a task."""
    docs, names = aside(docs, [ids_col, decoded_col])
    text_col = names[text_col]
    kept = [c for c in docs.columns if c != text_col]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(model_path)
        for part in parts:
            found = coder.encode([x.as_py() or "" for x in part.column(part.schema.get_field_index(text_col))])
            flat, ends = np.frombuffer(b"".join(found), "<i4"), np.cumsum([0] + [len(x) // 4 for x in found])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            decoded = pa.array([coder.decode(flat[a:b]) for a, b in zip(ends.tolist(), ends[1:].tolist(), strict=False)], pa.string())
            yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in kept), ids, decoded], [*kept, ids_col, decoded_col])

    small_batches(docs.sparkSession)
    more = [T.StructField(ids_col, T.ArrayType(T.IntegerType())), T.StructField(decoded_col, T.StringType())]
    return docs.mapInArrow(run, T.StructType([*(f for f in docs.schema if f.name in kept), *more]))


def digests(coded: DataFrame, ids_col: str = "ids") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of encoded and decoded rows."""
    import hashlib

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            raw = [x.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes() for x in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) // 4 for x in raw], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in raw]), part.column(2)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return coded.select("doc_id", ids_col, F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

"""SentencePiece encoding and decoding by vectorised merge rounds.

A model's pieces are read once on the driver and become a table of pairs: for every piece
and every cut of it, (left symbol, right symbol) -> piece and its rank.  The tables have the
size of the vocabulary (a few MB) and are broadcast.  In a task the normalised texts are cut
into words (spaces, then what follows up to the next space: no piece crosses that border,
which is checked when a model is read).  The distinct words of a batch that the task hasn't
met yet lie in one flat numpy array of symbols.  A round takes the lowest pair rank of each
word, merges its leftmost pairs that don't overlap, and compacts the array, until no word
has a pair left.

The library merges one pair at a time, lowest rank first, leftmost first.  Merging all
pairs of a rank at once gives the same unless a merged symbol may enter a pair of lower or
equal rank, which could reach the next place of the same pair; the pieces with that trait
are known from the vocabulary, and of them a round merges only the leftmost.  A word of
more than ``LONG`` symbols, in which rounds would cost the square of its length, is merged
through a priority queue in the same order.

Defined cases: null and empty texts have the begin and end ids alone and decode to the
empty text; U+2581 counts as a space, as in the library; characters without a piece become
byte pieces; repeated rows each get a row; other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickvault.llm.common import map_batches, use_small_batches

LONG = 512
CACHED = 300_000            # distinct words a task keeps
MARK = "▁"             # a space inside pieces
WORD = re.compile(" *[^ ]+| +")
NEVER = np.int32(2 ** 31 - 1)


def _each_byte(error):
    return "\ufffd" * (error.end - error.start), error.end


def _valid(text: bytes) -> bytes:
    try:
        text.decode()
        return text
    except UnicodeDecodeError:
        codecs.register_error("each-byte", _each_byte)
        return text.decode(errors="each-byte").encode()


class PieceModel:
    """Tables of a BPE model with byte fallback, identity normaliser and dummy prefix."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        if model.normalize("  a  b ") != MARK * 3 + "a" + MARK * 2 + "b" + MARK:
            raise ValueError("the model must have the identity normaliser and a dummy prefix")
        n = model.vocab_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(n)]
        if any(model.is_unused(i) for i in range(n)):
            raise ValueError("models with unused pieces aren't supported")
        text = [model.id_to_piece(i) for i in range(n)]
        ids = {text[i]: i for i in range(n) if not special[i]}
        if any(not re.fullmatch(f"{MARK}*[^{MARK}]*", p) for p in ids):
            raise ValueError("a piece crosses the border of two words")
        self.bos, self.eos, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        self.byte_ids = np.full(256, -1, np.int32)
        self.surface: list[bytes] = []
        for i, p in enumerate(text):
            if model.is_byte(i):
                self.byte_ids[int(p[3:5], 16)] = i
                self.surface.append(bytes([int(p[3:5], 16)]))
            else:
                self.surface.append(b"" if model.is_control(i) else " ⁇ ".encode() if special[i]
                                    else p.replace(MARK, " ").encode())
        if (self.byte_ids < 0).any():
            raise ValueError("the model must have a piece for every byte")
        self.control = np.array([model.is_control(i) for i in range(n)])
        self.spaced = np.array([not s and p.startswith(MARK) for s, p in zip(special, text)])
        # Characters inside pieces which are no pieces themselves get numbers from n on.
        symbols = dict(ids)
        for c in sorted({c for p in ids for c in p} - ids.keys()):
            symbols[c] = len(symbols) + n
        levels = {s: k for k, s in enumerate(sorted({-model.get_score(i) for i in ids.values()}))}
        self.rank = np.full(n, NEVER, np.int32)
        for i in ids.values():
            self.rank[i] = levels[-model.get_score(i)]
        equal = np.bincount(self.rank[list(ids.values())], minlength=len(levels)) > 1
        keys, made, alone = [], [], np.zeros(len(levels), bool)
        for p, i in ids.items():
            for k in range(1, len(p)):
                left, right = symbols.get(p[:k]), symbols.get(p[k:])
                if left is None or right is None:
                    continue
                keys.append(left << 32 | right)
                made.append(i)
                for part in (left, right):
                    if part < n and self.rank[part] >= self.rank[i]:
                        alone[self.rank[part]] = True
        order = np.argsort(np.array(keys, np.int64))
        self.pairs, self.made = np.array(keys, np.int64)[order], np.array(made, np.int32)[order]
        self.alone = alone | equal       # ranks of which a round merges only the leftmost pair
        one = {(" " if c == MARK else c): s for c, s in symbols.items() if len(c) == 1}
        self.chars, self.firsts = np.array([ord(c) for c in one], np.int64), np.array(list(one.values()), np.int32)
        self.size, self.free = n, max(symbols.values()) + 1      # free: a symbol in no pair


class Encoder:
    """A task's view of a model, with the words it has met."""

    def __init__(self, model: PieceModel):
        self.m = model
        self.first = np.full(0x110000, model.free, np.int32)
        self.first[model.chars] = model.firsts
        self.by_pair = dict(zip(model.pairs.tolist(), model.made.tolist()))
        self._forget()

    def _forget(self) -> None:
        self.words: dict[str, int] = {}
        self.tokens, self.starts, self.lengths = (np.empty(0, t) for t in (np.int32, np.int64, np.int64))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text, begin and end ids included."""
        if len(self.words) > CACHED:
            self._forget()
        words, new, numbers, ends = self.words, [], [], []
        for text in texts:
            if text:
                if MARK in text:
                    text = text.replace(MARK, " ")
                for w in WORD.findall(" " + text):
                    k = words.get(w)
                    if k is None:
                        k = words[w] = len(words)
                        new.append(w)
                    numbers.append(k)
            ends.append(len(numbers))
        if new:
            tokens, lengths = self.merge(new)
            self.starts = np.concatenate([self.starts, len(self.tokens) + np.cumsum(lengths) - lengths])
            self.tokens = np.concatenate([self.tokens, tokens])
            self.lengths = np.concatenate([self.lengths, lengths])
        at = np.array(numbers, np.int64)
        size = self.lengths[at]
        upto = np.concatenate([[0], np.cumsum(size)])
        flat = self.tokens[np.repeat(self.starts[at] - upto[:-1], size) + np.arange(upto[-1])]
        cuts = upto[np.array([0] + ends)]
        begin, end = np.array([self.m.bos], np.int32), np.array([self.m.eos], np.int32)
        return [np.concatenate([begin, flat[a:b], end]) for a, b in zip(cuts[:-1], cuts[1:])]

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.m.pairs, key), len(self.m.pairs) - 1)
        made = np.where(self.m.pairs[at] == key, self.m.made[at], -1)
        return made, np.where(made >= 0, self.m.rank[made], NEVER)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words, and the number of each."""
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        size = np.fromiter(map(len, words), np.int64, len(words))
        final = self.first[code]                 # symbol by the place of its first character
        alive = np.ones(len(code), bool)
        owner = np.repeat(np.arange(len(words)), size)
        begin = np.cumsum(size) - size
        for w in np.flatnonzero(size > LONG):
            self._queue(final, alive, int(begin[w]), int(size[w]))
        place = np.flatnonzero((size <= LONG)[owner])
        symbol, word = final[place], owner[place]
        made, rank = np.full(len(place), -1, np.int32), np.full(len(place), NEVER)
        inside = np.flatnonzero(word[:-1] == word[1:])
        made[inside], rank[inside] = self._look_up(symbol[inside], symbol[inside + 1])
        while len(symbol):
            head = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            low = np.minimum.reduceat(rank, head)
            span = np.diff(np.append(head, len(word)))
            if (low == NEVER).any():             # words without a pair are done
                stay = np.repeat(low != NEVER, span)
                place, symbol, word, made, rank = (x[stay] for x in (place, symbol, word, made, rank))
                span, low = span[low != NEVER], low[low != NEVER]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == np.repeat(low, span))
            first = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
            run = np.concatenate([[True], (at[1:] != at[:-1] + 1) | first[1:]])
            step = np.arange(len(at))
            even = (step - step[np.flatnonzero(run)][np.cumsum(run) - 1]) % 2 == 0
            at = at[np.where(self.m.alone[rank[at]], first, even)]
            symbol[at] = made[at]
            final[place[at]] = made[at]
            alive[place[at + 1]] = False
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            now = (np.cumsum(keep) - 1)[at]      # the merged symbols' places after compaction
            place, symbol, word, made, rank = (x[keep] for x in (place, symbol, word, made, rank))
            for left in (now, now[now > 0] - 1):
                left = left[left + 1 < len(symbol)]
                same = word[left] == word[left + 1]
                made[left], rank[left] = -1, NEVER
                left = left[same]
                made[left], rank[left] = self._look_up(symbol[left], symbol[left + 1])
            if len(symbol):
                made[-1], rank[-1] = -1, NEVER
        return self._with_bytes(final[alive], code[alive], owner[alive], len(words))

    def _with_bytes(self, token: np.ndarray, code: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece as byte pieces."""
        bare = token >= self.m.size
        code = code.astype(np.int64)
        need = np.where(bare, 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF), 1)
        out = np.repeat(token, need)
        start = np.cumsum(need) - need
        for k in (1, 2, 3, 4):
            own = np.flatnonzero(bare & (need == k))
            for i in range(k):
                bits = code[own] >> 6 * (k - 1 - i)
                byte = bits if k == 1 else (bits | (0xF00 >> k & 0xFF)) if i == 0 else (bits & 0x3F | 0x80)
                out[start[own] + i] = self.m.byte_ids[byte]
        return out, np.bincount(owner, need, minlength=n).astype(np.int64)

    def _queue(self, final: np.ndarray, alive: np.ndarray, start: int, size: int) -> None:
        symbol = final[start:start + size].tolist()
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        gone, heap, made = [False] * size, [], self.by_pair

        def offer(a: int, b: int) -> None:
            p = made.get(symbol[a] << 32 | symbol[b])
            if p is not None:
                heapq.heappush(heap, (int(self.m.rank[p]), a, b, symbol[a], symbol[b], p))

        for k in range(size - 1):
            offer(k, k + 1)
        while heap:
            _, a, b, x, y, p = heapq.heappop(heap)
            if gone[a] or gone[b] or symbol[a] != x or symbol[b] != y:
                continue
            symbol[a], gone[b] = p, True
            after[a] = after[b]
            if after[a] < size:
                before[after[a]] = a
                offer(a, after[a])
            if before[a] >= 0:
                offer(before[a], a)
        final[start:start + size] = symbol
        alive[start:start + size] = ~np.array(gone)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text that ``ids`` stand for; every byte that is none becomes U+FFFD."""
        control = self.m.control[ids]
        shown = ids[~control]
        if not len(shown):
            return b""
        text = b"".join(map(self.m.surface.__getitem__, shown.tolist()))
        skip = int(self.m.spaced[shown[0]])
        between = np.flatnonzero(control)
        if between.size and between.max() > np.flatnonzero(~control).min() and (between < len(ids) - 1).any():
            # Bytes on both sides of a control piece don't form one character.
            return b"".join(_valid(b"".join(map(self.m.surface.__getitem__, part[~self.m.control[part]].tolist())))
                            for part in np.split(ids, between))[skip:]
        return _valid(text)[skip:]


def _encoder(shared, _kept: list = []) -> Encoder:  # noqa: B006 - one encoder a task
    if not _kept:
        _kept.append(Encoder(shared.value))
    return _kept[0]


def _rows(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    use_small_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def _texts(cols: dict) -> list[str | None]:
    return [None if t is None else t.decode() for t in cols["text"]]


def encode(docs: DataFrame, model_path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and ids (array of int, begin and end included) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(PieceModel(model_path))

    def run(cols):
        ids = _encoder(shared).encode(_texts(cols))
        yield {"doc_id": cols["doc_id"], "ids": pa.array(ids, pa.list_(pa.int32()))}

    return map_batches(_rows(docs, text, doc_id), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_path: str, ids: str = "ids", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and text of every row of ids; null ids count as none, ids outside the vocabulary are an error."""
    shared = encoded.sparkSession.sparkContext.broadcast(PieceModel(model_path))
    use_small_batches(encoded.sparkSession)
    rows = encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).cast("array<int>").alias("ids"))

    def run(cols):
        every = [np.array([x for x in r or [] if x is not None], np.int64) for r in cols["ids"].to_pylist()]
        if any(len(x) and (x.min() < 0 or x.max() >= shared.value.size) for x in every):
            raise ValueError("ids outside the vocabulary")
        yield {"doc_id": cols["doc_id"], "text": [_encoder(shared).decode(x).decode() for x in every]}

    return map_batches(rows, run, "doc_id long, text string")


def digests(docs: DataFrame, model_path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Both ways in one pass: number and hash of the ids, hash of the text decoded from them."""
    shared = docs.sparkSession.sparkContext.broadcast(PieceModel(model_path))

    def run(cols):
        enc = _encoder(shared)
        ids = enc.encode(_texts(cols))
        yield {"doc_id": cols["doc_id"], "n_tokens": [len(x) for x in ids],
               "ids_sha256": [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids],
               "decoded_sha256": [hashlib.sha256(enc.decode(x)).hexdigest() for x in ids]}

    return map_batches(_rows(docs, text, doc_id), run,
                       "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op13_sentence_pieces(spark, sf_dir: str, model_path: str | None = None) -> DataFrame:
    if model_path is None:
        import public_tokenizers

        model_path = public_tokenizers.path("piece_bpe_32k.model")
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), model_path)

"""Exact encoding and decoding for merge-type (BPE) SentencePiece models.

Encoding finds the one tokenisation in which every two adjacent tokens are
compatible, that is, merging their joined text again gives the same two
tokens.  An Aho-Corasick automaton reports the pieces that start at each
place; the text is tokenised by taking the longest piece that is compatible
with the one before it, and by backtracking to a shorter one (a piece's own
longest beginning) where none fits.  A bitfield marks the places from which the
rest cannot be tokenised, so each is tried once and the time stays linear.

A text is cut where no piece can stand across (before a word break that
follows another character, and around line feeds, if the vocabulary proves
it), so equal words are encoded once and remembered.  Runs of word breaks, whose pieces have equal
scores, and pairs of tokens are merged in the library's order: best score
first, then leftmost.  Characters without a piece become their UTF-8 bytes.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from strideframe.llm.common import append_columns, read_table

BREAK = "▁"
#: Words, and pairs of tokens, that a worker remembers.
MEMORY, PAIRS = 300_000, 400_000

_WORDS = re.compile(f"\n|{BREAK}+[^{BREAK}\n]*|[^{BREAK}\n]+")


class Codec:
    """Encoder and decoder for the model held in ``model`` (its file's bytes)."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.end = sp.eos_id()
        pieces = [sp.id_to_piece(i) for i in range(sp.piece_size())]
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(pieces) if sp.is_byte(i)}
        self.ids = {p: i for i, p in enumerate(pieces)
                    if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        if len(self.byte) != 256:
            raise ValueError("the model needs byte fallback")
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        # a word break that follows another character starts a piece of its own
        self.cuts = not any(BREAK in p.lstrip(BREAK) or "\n" in p for p in self.ids)
        self.chars = frozenset(p for p in self.ids if len(p) == 1)
        # of each piece the longest other piece (or unknown character) that it begins with
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in self.ids), p[:1] if len(p) > 1 else "")
                        for p in self.ids}
        self.number = {p: str(i) for p, i in self.ids.items()}
        self.shown = {p: p.replace(BREAK, " ") for p in self.ids}
        self.whole: dict[str, bool] = {}
        self.fits: dict[str, dict[str, bool]] = {}
        self.pairs = 0
        self.parts: dict[str, list[str]] = {}
        self.words: dict[str, tuple[int, str, str]] = {}

    # -- merging ------------------------------------------------------------

    def merge(self, text: str) -> list[str]:
        """Pieces after repeatedly joining the adjacent pair with the best
        score (leftmost of equals): the definition of the encoding."""
        return self._merge_short(text) if len(text) <= 40 else self._merge_long(text)

    def _merge_short(self, text: str) -> list[str]:
        """``merge`` by scanning the pairs for the best one."""
        part, score, none = list(text), self.score, float("-inf")
        pairs = [score.get(x + y, none) for x, y in zip(part, part[1:])]
        while pairs and (best := max(pairs)) > none:
            i = pairs.index(best)
            part[i:i + 2] = [part[i] + part[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = score.get(part[i] + part[i + 1], none)
            if i:
                pairs[i - 1] = score.get(part[i - 1] + part[i], none)
        return part

    def _merge_long(self, text: str) -> list[str]:
        """``merge`` with a heap of the pairs."""
        part, n = list(text), len(text)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def offer(i: int) -> None:
            j = right[i]
            if j < n and (s := self.score.get(part[i] + part[j])) is not None:
                heapq.heappush(heap, (-s, i, j, len(part[i]), len(part[j])))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, j, a, b = heapq.heappop(heap)
            if part[i] is None or part[j] is None or right[i] != j or (len(part[i]), len(part[j])) != (a, b):
                continue
            part[i] += part[j]
            part[j] = None
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [p for p in part if p is not None]

    def _is_token(self, piece: str) -> bool:
        """Whether the merges ever make the piece."""
        ok = self.whole.get(piece)
        if ok is None:
            ok = self.whole[piece] = len(piece) == 1 or self.merge(piece) == [piece]
        return ok

    def _compatible(self, a: str, b: str) -> bool:
        """Whether ``b`` can follow ``a``, or (``a`` empty) begin a text."""
        if not a:
            return self._is_token(b)
        ok = self.fits.get(a, {}).get(b)
        if ok is None:
            if self.pairs >= PAIRS:
                self.fits.clear()
                self.pairs = 0
            self.pairs += 1
            ok = self.fits.setdefault(a, {})[b] = self._is_token(b) and self.merge(a + b) == [a, b]
        return ok

    # -- encoding -----------------------------------------------------------

    def _backtrack(self, text: str) -> list[str]:
        """The compatible tokenisation of ``text``, found from its start."""
        n = len(text)
        longest = [""] * (n + 1)                    # the longest piece that starts at each place
        for last, piece in self.automaton.iter(text):       # shortest first at each start
            longest[last - len(piece) + 1] = piece
        if not self.chars.issuperset(text):
            for at, c in enumerate(text):
                if not longest[at]:
                    longest[at] = c                 # unknown characters are tokens of their own
        failed = bytearray(n // 8 + 1)              # places after which nothing fits
        tokens: list[str] = []
        shorter, fits, none = self.shorter, self.fits, {}
        at, before, some_failed, known = 0, "", False, self.whole
        p = longest[0]
        while at < n:
            while p:
                end = at + len(p)
                if not (some_failed and failed[end >> 3] >> (end & 7) & 1):
                    ok = known.get(p)
                    if ok is None:
                        ok = self._compatible(before, p)
                    if ok:
                        break
                p = shorter.get(p, "")
            if p:
                tokens.append(p)
                at, before, p = end, p, longest[end]
            else:
                if not tokens:
                    raise ValueError("no tokenisation")     # cannot happen: single characters always fit
                failed[at >> 3] |= 1 << (at & 7)
                some_failed = True
                last = tokens.pop()
                at -= len(last)
                before, p = tokens[-1] if tokens else "", shorter.get(last, "")
            known = fits.get(before, none) if before else self.whole
        return tokens

    def _parts(self, word: str) -> list[str]:
        """Tokens of a word.  Its letters and the signs after them are
        tokenised apart and remembered: the two results together are the
        tokenisation if their adjacent tokens are compatible."""
        cut = len(word)
        while cut and not word[cut - 1].isalnum():
            cut -= 1
        if 0 < cut < len(word):
            a, b = self._letters(word[:cut]), self._letters(word[cut:])
            if self._compatible(a[-1], b[0]):
                return a + b
        return self._letters(word)

    def _letters(self, text: str) -> list[str]:
        got = self.parts.get(text)
        if got is None:
            if len(self.parts) >= MEMORY:
                self.parts.clear()
            got = self.parts[text] = self._backtrack(text)
        return got

    def _ids_of(self, tokens: list[str]) -> list[int]:
        out: list[int] = []
        for t in tokens:
            i = self.ids.get(t)
            if i is None:
                out += [self.byte[b] for b in t.encode()]
            else:
                out.append(i)
        return out

    def _tokens(self, text: str) -> list[str]:
        """Tokens of a run of word breaks and what follows it up to the next."""
        if not self.cuts or text[1:2] != BREAK or text[0] != BREAK:
            return self._parts(text)
        bare = text.lstrip(BREAK)
        n = len(text) - len(bare)
        if not bare:
            return self.merge(text)
        # merges inside the word, its own break included, come before those of the run
        tokens = self._parts(BREAK + bare)
        run = n if tokens[0] == BREAK else n - 1
        return self.merge(BREAK * run) + (tokens[1:] if tokens[0] == BREAK else tokens)

    def encode(self, text: str) -> list[int]:
        """Ids of a text, without an end id."""
        return [i for w in self._split(text) for i in self._ids_of(self._tokens(w))]

    def _split(self, text: str) -> list[str]:
        """Words with the breaks before them; the library puts one break
        before a text that is not empty."""
        if not text:
            return []
        text = BREAK + text.replace(" ", BREAK)
        if not self.cuts:
            return [text]
        return _WORDS.findall(text)

    def remembered(self, word: str) -> tuple[int, str, str]:
        """(number of ids, ids as text, decoded text) of a word."""
        got = self.words.get(word)
        if got is None:
            if len(self.words) >= MEMORY:
                self.words.clear()
            tokens = self._tokens(word)
            try:
                got = (len(tokens), " ".join(map(self.number.__getitem__, tokens)),
                       "".join(map(self.shown.__getitem__, tokens)))
            except KeyError:        # a character without a piece: bytes
                ids = self._ids_of(tokens)
                got = (len(ids), " ".join(map(str, ids)), self.decode_pieces(ids))
            if len(word) <= 32:
                self.words[word] = got
        return got

    # -- decoding -----------------------------------------------------------

    def decode_pieces(self, ids: list[int]) -> str:
        """Text of the ids: bytes are gathered into characters (an incomplete
        one becomes U+FFFD), word breaks become spaces; nothing is cut off."""
        if not hasattr(self, "texts"):
            self.texts = {i: p.replace(BREAK, " ").encode() for p, i in self.ids.items()}
            self.texts |= {i: bytes([b]) for b, i in self.byte.items()}
        return b"".join([self.texts.get(i, b"") for i in ids]).decode("utf-8", "replace")

    def decode(self, ids: list[int]) -> str:
        """Text of a whole sequence: without the one space before it."""
        text = self.decode_pieces(ids)
        return text[1:] if text[:1] == " " else text


_CODECS: dict[bytes, Codec] = {}


def _codec(model: bytes) -> Codec:
    """One codec per worker process and model; its memory of words is bounded."""
    key = hashlib.sha256(model).digest()
    if key not in _CODECS:
        _CODECS[key] = Codec(model)
    return _CODECS[key]


def _model(path: str | None) -> bytes:
    """The model's bytes, read on the driver and shipped with the job."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


def encode_texts(docs: DataFrame, model_path: str | None = None, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text, an end id last (null: only
    the end id, as for an empty text).  Other columns pass through (one named
    like the new column is replaced); an empty table stays empty."""
    model = _model(model_path)

    def compute(batch: pa.RecordBatch):
        c = _codec(model)
        rows = [[*c.encode(t.as_py() or ""), c.end] for t in batch.column(text)]
        return [pa.array(rows, pa.list_(pa.int32()))]

    return append_columns(docs, [(ids, "array<int>")], compute)


def decode_texts(docs: DataFrame, model_path: str | None = None, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of each id sequence (null: empty)."""
    model = _model(model_path)

    def compute(batch: pa.RecordBatch):
        c = _codec(model)
        return [pa.array([c.decode(x.as_py() or []) for x in batch.column(ids)], pa.string())]

    return append_columns(docs, [(text, "string")], compute)


def round_trip(docs: DataFrame, model_path: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens (all ids, the end id included), ids_sha256 (of
    the decimal ids joined by spaces) and decoded_sha256 (of the text that the
    ids decode to), the digests of ``encode_texts`` and ``decode_texts``.

    Null counts as empty: one id, the end.  Repeated rows get equal digests.
    Other columns pass through (columns with the names of the new ones are
    replaced); an empty table stays empty.
    """
    model = _model(model_path)

    def compute(batch: pa.RecordBatch):
        c = _codec(model)
        counts, of_ids, of_text = [], [], []
        for t in batch.column(text):
            got = [c.remembered(w) for w in c._split(t.as_py() or "")]
            counts.append(sum([g[0] for g in got]) + 1)
            of_ids.append(hashlib.sha256(" ".join([*[g[1] for g in got], str(c.end)]).encode()).hexdigest())
            decoded = "".join([g[2] for g in got])
            of_text.append(hashlib.sha256(decoded[1:].encode() if decoded[:1] == " " else decoded.encode()).hexdigest())
        return [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]

    return append_columns(docs, [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")], compute)


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Query: doc_id and the digests of ``round_trip`` for every document."""
    return round_trip(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def encoding_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return round_trip(docs.select("doc_id", "text")).drop("text")

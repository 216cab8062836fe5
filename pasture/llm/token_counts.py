"""Token counts of whole documents, with overlap resynchronisation for huge ones.

A huge document is never handed to the tokenizer whole.  Overlapping chunks are encoded with offsets; two
neighbouring chunks are spliced at a boundary where a token starts in both and which is proven stable: nothing on its
far side can change the tokens on this side.  The proof reads a few characters around the place:

* white space before it, which the pre-tokenizer never joins to anything;
* a change of the pre-tokenizer's class (letter, digit, other) that no contraction such as ``'re`` can bridge;
* inside a run of one class, two bytes that stand side by side in no token of the vocabulary: no merge can cross them.

The last two count only among characters that normalisation leaves alone, and not inside a special string.  Where the
encodings do not meet at such a place, an earlier one is tried with a wider overlap; a chunk without any is widened to
the next one.  Only a run without any such place is encoded in one piece.

The first proof lets ordinary documents be counted piece by piece between white space, with a bounded cache of
piece counts in each Python worker.
"""

from __future__ import annotations

import os
from bisect import bisect_left
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from pasture.llm.scratch import pick

CHUNK, OVERLAP = 1 << 15, 1 << 8
CACHE = 400_000
_SPACE = " \t\n\r\x0b\x0c"
_COUNTERS: dict[str, Counter] = {}
#: Letters without case, marks or decompositions: Thai, kana, ideographs, Hangul syllables.
_LETTERS = ((0xE01, 0xE2E), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3))
#: Other characters that normalisation leaves alone: CJK and full-width punctuation, pictographs.
_OTHERS = ((0x3001, 0x3002), (0x300A, 0x300F), (0xFF01, 0xFF0F), (0xFF1A, 0xFF1B), (0xFF1F, 0xFF1F), (0x1F300, 0x1F5FF), (0x1F600, 0x1F64F))


@lru_cache(1 << 16)
def _kind(c: str) -> str:
    """The pre-tokenizer's class of a character: L, N, other (S), or none for white space and all that may change."""
    o = ord(c)
    if o < 128:
        return "L" if c.isalpha() else "N" if c.isdigit() else "S" if 32 < o < 127 else ""
    return "L" if any(a <= o <= b for a, b in _LETTERS) else "S" if any(a <= o <= b for a, b in _OTHERS) else ""


class Counter:
    """Counts tokens with one tokenizer file of the ``tokenizers`` library; one per Python worker and file."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP, cache: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.chunk, self.overlap, self.cache = chunk, overlap, cache
        self.known: dict[bytes, int] = {}
        self.widened = 0
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        vocab = [t.removesuffix("</w>") for t in self.tok.get_vocab() if t not in self.special]
        self.pairs = {t[i:i + 2] for t in vocab for i in range(len(t) - 1)}
        self.symbols: dict[str, str] = {}

    def many(self, texts: list[bytes]) -> list[int]:
        """Counts of a batch of UTF-8 texts; unseen pieces are encoded together."""
        out = [0] * len(texts)
        for i, t in enumerate(texts):
            if len(t) > self.chunk:
                out[i] = self.spliced(t.decode("utf-8", "replace"))
                continue
            pieces = t.split()
            if new := list(set(pieces).difference(self.known)):
                if len(self.known) + len(new) > self.cache:
                    self.known.clear()
                    new = list(set(pieces))
                codes = self.tok.encode_batch_fast([p.decode("utf-8", "replace") for p in new], add_special_tokens=False)
                self.known.update(zip(new, map(len, codes)))
            out[i] = sum(map(self.known.__getitem__, pieces))
        return out

    def _starts(self, text: str, a: int, b: int) -> list[int]:
        return [a + s for s, _ in self.tok.encode(text[a:b], add_special_tokens=False).offsets]

    def _symbols(self, c: str) -> str:
        """A character as the symbols of the byte-level alphabet that merges begin with."""
        if c not in self.symbols:
            if len(self.symbols) > self.cache:
                self.symbols.clear()
            self.symbols[c] = self.tok.pre_tokenizer.pre_tokenize_str(c.lower())[0][0]
        return self.symbols[c]

    def stable(self, text: str, x: int) -> bool:
        """Whether a token starts at ``x`` and neither side of it can change the tokens of the other."""
        if text[x].isspace():
            return False
        if text[x - 1] in _SPACE:
            return True
        # the character after: a mark there would change the one at x
        before, here, after = _kind(text[x - 1]), _kind(text[x]), x + 1 == len(text) or text[x + 1] in _SPACE or _kind(text[x + 1])
        if not (before and here and after):
            return False
        if before == here != "N":
            if self._symbols(text[x - 1])[-1] + self._symbols(text[x])[0] in self.pairs:
                return False
            if here == "S" and "'" in text[x - 1:x + 1]:
                return False
        elif before == "S" and here == "L" and text[x - 1] == "'":
            return False
        return not any(0 <= text.find(t, max(0, x - len(t) + 1), x + len(t) - 1) for t in self.special)

    def _last(self, text: str, a: int, b: int) -> int | None:
        """The last stable place between ``a`` and ``b``."""
        return next((x for x in range(b - 1, a, -1) if self.stable(text, x)), None)

    def spliced(self, text: str) -> int:
        """Tokens of a huge text, chunk by chunk; holds two chunks' offsets at a time."""
        n, total, since, back = len(text), 0, 0, 0
        end = min(n, self.chunk)
        left = self._starts(text, 0, end)
        while end < n:
            x, overlap, right = self._last(text, since, end), self.overlap, None
            while x is not None:
                start, stop = max(since, x - overlap), min(n, x + self.chunk)
                right = self._starts(text, start, stop)
                i, j = bisect_left(left, x), bisect_left(right, x)
                if i < len(left) and j < len(right) and left[i] == right[j] == x:
                    break
                self.widened += 1
                x, overlap = self._last(text, since, x), 2 * overlap
            if x is None:                   # the chunk holds no stable place: widen it beyond the next one
                self.widened += 1
                ahead = next((y for y in range(end, n) if self.stable(text, y)), n)
                end = min(n, ahead + self.overlap)
                left = self._starts(text, back, end)
                continue
            total += i - bisect_left(left, since)
            since, back, end, left = x, start, stop, right
        return total + len(left) - bisect_left(left, since)


def counter(path: str, **options) -> Counter:
    """This worker's counter for a tokenizer file."""
    key = f"{path} {sorted(options.items())}"
    if key not in _COUNTERS:
        _COUNTERS[key] = Counter(path, **options)
    return _COUNTERS[key]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048, **options) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of ``docs`` (doc_id, text).

    ``tokenizer`` is the path of a vocabulary file present on every executor.  Null texts count as empty (0 bytes,
    0 tokens); special strings inside a text count as the library counts them; repeated rows each return a row.
    """
    def run(batches):
        c = counter(tokenizer, **options)
        for b in batches:
            texts = [t or b"" for t in b.column("text").to_pylist()]
            n = c.many(texts)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return pick(docs, doc_id="bigint", text="binary").mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")

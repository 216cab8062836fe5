"""BPE encoding and decoding as streaming transducers.

Encoding reads a text piece by piece and emits a token as soon as it is stable, that is, as soon as nothing that may
follow can change it.  The lookahead this takes follows from the merge list.  Let ``lookahead`` be the length of its
longest token.  Whatever follows position n, the token that covers n starts after n - lookahead, and the tokens before
that start are the encoding of the prefix that ends there (no merge crosses a token boundary, so a prefix of an
encoding is the encoding of its text).  So the tokens that the encodings of all prefixes ending in (n - lookahead, n]
have in common are final.  The encoding of a prefix is that of a shorter one plus one last token, and two neighbours
are valid exactly if encoding their joint text gives the two of them; so the transducer keeps one back-pointer per
position since the last final boundary, and nothing else.

A word's end makes all of its tokens stable.  A word that ends within the lookahead never has a stable token before, so
the transducer holds its symbols, at most ``lookahead`` of them, and merges them when it ends.  What a word gave is
remembered by the worker, within bounds; texts are read in blocks.

Decoding is the reverse state machine: token to bytes, bytes to text, one token at a time, holding at most the three
bytes of an unfinished character.  The decoded text is made of the ids that the transducer emitted, never of its input.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import itertools
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from pasture.llm.scratch import pick

SHORT = 48              # bytes; what longer pieces gave is not remembered
BLOCK = 1 << 16         # bytes of a text read at once; longer stretches without white space are streamed word by word
_SPACE = re.compile(rb"[\t-\r ]")
CACHE = 300_000         # pieces between white space that a worker remembers (twice, see _Memo); words: two thirds
_CODERS: dict[str, Coder] = {}


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte, by the byte-level rule: printable Latin-1 bytes stand for themselves,
    the others for the code points from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    return [chr(b if b in own else next(other)) for b in range(256)]


class _Memo(dict):
    """Results by key, in two generations: a full one steps back, so that frequent keys stay."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
            if len(key) > SHORT:
                return found
        if len(self) >= self.size:
            self.old = self.copy()
            self.clear()
        self[key] = found
        return found


class Coder:
    """Encoder and decoder of one tokenizer file: byte-level BPE with an end-of-word suffix, NFC, lower case."""

    def __init__(self, path: str, cache: int = CACHE):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = dict(model["vocab"])
        self.rank = {tuple(m.split(" ") if isinstance(m, str) else m): r for r, m in enumerate(model["merges"])}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        words = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(words.replace(r"\s", r"\p{White_Space}"))
        # the same over ASCII, lower-cased
        self.split_ascii = re.compile(words.replace(r"\s", r"\t-\r ").replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9"))
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.text_of = {i: t for t, i in (self.ids | self.special).items()}
        self.symbol = byte_symbols()
        self.printed = dict(enumerate(self.symbol))
        self.byte = {s: b for b, s in enumerate(self.symbol)}
        self.lookahead = max(len(t.removesuffix(self.suffix)) for t in self.ids)
        self.cache = cache
        self.words = _Memo(self._word, 2 * cache // 3)
        self.pieces = _Memo(self._piece, cache)
        self.pairs: dict[tuple[str, str], bool] = {}

    # -- encoding --------------------------------------------------------------------------------------------------
    def symbols(self, word: str) -> list[str]:
        out = list(word.encode("utf-8").decode("latin-1").translate(self.printed))
        if out:
            out[-1] += self.suffix
        return out

    def merged(self, s: list[str]) -> list[str]:
        """Merges of a bounded word, lowest rank first, leftmost first."""
        s, none = list(s), len(self.rank)
        rank = self.rank.get
        ranks = [rank(p, none) for p in zip(s, s[1:])]
        while ranks and (k := min(ranks)) < none:
            i = ranks.index(k)
            s[i] += s.pop(i + 1)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank((s[i], s[i + 1]), none)
            if i:
                ranks[i - 1] = rank((s[i - 1], s[i]), none)
        return s

    def _parts(self, token: str) -> list[str]:
        body = token.removesuffix(self.suffix) if self.suffix else token
        return [*body[:-1], body[-1] + token[len(body):]]

    def _valid(self, left: str, right: str) -> bool:
        """Whether two tokens may be neighbours; with an empty left: whether a token is its own encoding."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > self.cache:
                self.pairs.clear()
            tokens = [left, right] if left else [right]
            known = self.pairs[left, right] = self.merged([x for t in tokens for x in self._parts(t)]) == tokens
        return known

    def stream(self, symbols: Iterable[str]) -> Iterator[str]:
        """Tokens of one word of any length, each emitted once it is stable.

        ``held`` are the symbols since the last final boundary; ``last[i]`` is the token that ends the encoding of
        its first i symbols.
        """
        symbols = iter(symbols)
        first = list(itertools.islice(symbols, self.lookahead))
        if len(first) < self.lookahead:         # the end came first: nothing was stable before it
            yield from self.merged(first)
            return
        held: list[str] = []
        last: list[str] = [""]
        for x in itertools.chain(first, symbols):
            held.append(x)
            tail, n = "", len(held)
            for k in range(n - 1, max(-1, n - 1 - self.lookahead), -1):
                tail = held[k] + tail
                if tail in self.ids and self._valid("", tail) and (k == 0 or self._valid(last[k], tail)):
                    break
            last.append(tail)
            if n >= 4 * self.lookahead and n % self.lookahead == 0:
                final = self._agreed(last, n)
                yield from final
                done = sum(len(self._parts(t)) for t in final)
                held, last = held[done:], ["", *last[done + 1:]]
        yield from self._path(last, len(held))

    def _path(self, last: list[str], n: int) -> list[str]:
        out = []
        while n:
            out.append(last[n])
            n -= len(self._parts(last[n]))
        return out[::-1]

    def _agreed(self, last: list[str], n: int) -> list[str]:
        """What the encodings of all prefixes ending in (n - lookahead, n] have in common: the path to the
        position where all their back-pointer chains have met."""
        heap = [-i for i in range(max(0, n - self.lookahead + 1), n + 1)]
        heapq.heapify(heap)
        while len(heap) > 1:
            i = -heapq.heappop(heap)
            while heap and heap[0] == -i:
                heapq.heappop(heap)
            if not heap:
                heap = [-i]
                break
            heapq.heappush(heap, -(i - len(self._parts(last[i]))))
        return self._path(last, -heap[0])

    def _word(self, word: str) -> tuple[int, bytes, bytes]:
        """One pre-token through the transducer, and its ids through the decoder: number of tokens, ids as text, decoded text."""
        ids = [self.ids[t] for t in self.stream(self.symbols(word))]
        return len(ids), b" ".join([b"%d" % i for i in ids]), "".join(self.decode(ids)).encode()

    def pre_tokens(self, text: str) -> Iterator[tuple[int, bytes, bytes]]:
        """The pre-tokens and special tokens of a text, in order."""
        parts = self.cut.split(text) if self.cut is not None and any([s in text for s in self.special]) else (text,)
        for p in parts:
            if p in self.special:
                i = self.special[p]
                yield 1, b"%d" % i, "".join(self.decode([i])).encode()
                continue
            ascii_only = p.isascii()
            p = p.lower() if ascii_only else unicodedata.normalize("NFC", p).replace("Σ", "σ").lower()   # no final-sigma rule
            split = self.split_ascii if ascii_only else self.split
            found = split.findall(p) if len(p) <= BLOCK else (m[0] for m in split.finditer(p))
            yield from map(self.words.__getitem__, found)

    def segment(self, text: str) -> Iterator[int]:
        """Ids of a text without white space (or of any text held in memory)."""
        return itertools.chain.from_iterable(map(int, w[1].split()) for w in self.pre_tokens(text))

    def encode(self, text: str) -> Iterator[int]:
        """Ids of a text, emitted as it is read; nothing joins across ASCII white space."""
        for m in regex.finditer(r"[^\x20\x09-\x0D]+", text):
            yield from self.segment(m[0])

    # -- decoding --------------------------------------------------------------------------------------------------
    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """The library's decoding for a file without decoder: token strings with one space between them."""
        gap = ""
        for i in ids:
            yield gap + self.text_of[i]
            gap = " "

    def text(self, ids: Iterable[int]) -> Iterator[str]:
        """Readable text, byte by byte through an incremental UTF-8 decoder; a word end becomes one space."""
        utf8 = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            t = self.text_of[i]
            if t in self.special:
                yield utf8.decode(b"", True) + t
                utf8.reset()
                continue
            body = t.removesuffix(self.suffix)
            out = utf8.decode(bytes(self.byte[c] for c in body), len(body) != len(t))
            yield out + (" " if len(body) != len(t) else "")
        yield utf8.decode(b"", True)

    # -- whole documents -------------------------------------------------------------------------------------------
    def _piece(self, piece: bytes) -> tuple[int, bytes, bytes]:
        """Of a text between white space: number of tokens, ids and decoded text (the library decodes a file without
        decoder to its token strings, with one space between them)."""
        found = list(self.pre_tokens(piece.decode("utf-8", "replace")))
        if len(found) == 1:
            return found[0]
        n, a, b = zip(*found) if found else ((), (), ())
        return sum(n), b" ".join(a), b" ".join(b)

    def _blocks(self, text: bytes) -> Iterator[bytes]:
        """The text in parts of some BLOCK bytes that end at ASCII white space."""
        at = 0
        while len(text) - at > BLOCK:
            end = max(text.rfind(c, at, at + BLOCK) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if end <= at:
                found = _SPACE.search(text, at + BLOCK)
                end = found.start() if found else len(text)
            yield text[at:end]
            at = end
        yield text[at:]

    def digests(self, text: bytes) -> tuple[int, str, str]:
        """(number of tokens, SHA-256 of the ids, SHA-256 of the decoded text), hashed as the tokens come."""
        n, a, b = 0, hashlib.sha256(), hashlib.sha256()

        def put(found):
            nonlocal n
            found = [f for f in found if f[0]]          # pieces of other white space have no token
            if found:
                many, ids, texts = zip(*found)
                gap = b" " if n else b""
                a.update(gap + b" ".join(ids))
                b.update(gap + b" ".join(texts))
                n += sum(many)

        for block in self._blocks(text):
            if len(block) > BLOCK:                      # no white space: pre-token by pre-token
                for some in itertools.batched(self.pre_tokens(block.decode("utf-8", "replace").strip(" \t\n\r\x0b\x0c")), 4096):
                    put(some)
            else:
                put(map(self.pieces.__getitem__, block.split()))
        return n, a.hexdigest(), b.hexdigest()


def coder(path: str, **options) -> Coder:
    """This worker's coder for a tokenizer file."""
    key = f"{path} {sorted(options.items())}"
    if key not in _CODERS:
        _CODERS[key] = Coder(path, **options)
    return _CODERS[key]


def round_trip(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row of ``docs`` (doc_id, text).

    Null texts count as empty: no tokens, digests of the empty string.  Repeated rows each return a row.
    """
    def run(batches):
        c = coder(tokenizer, **options)
        for b in batches:
            n, ids, text = zip(*(c.digests(t or b"") for t in b.column("text").to_pylist())) if len(b) else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return pick(docs, doc_id="bigint", text="binary").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")

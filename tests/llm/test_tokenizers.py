"""Token counts and the BPE transducer against the tokenizers library."""
import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pasture.llm.bpe_transducer import Coder, round_trip
from pasture.llm.token_counts import Counter, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, n_tokens string, ids string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rnd = random.Random(4)
    letters = ["abcdefghij", "thernsao", "ab", "0123456789", "éèñß", "!?.,-$", "aΣσςİIıẞßǅ", "中文字符ا ب", "́̀a e  \x0b\x0c\x1c\x85\t\n",
               "a\x1c\x1d\x1e\x1f\x7f\x00 b \xa0", "😀👩‍🔬é"]
    out = ["", " ", "Hello WORLD's <|endoftext|>x", "<|startoftext|><|endoftext|> a<|endof text|>", "don't we'll 'S x'RE", " ", "a   b"]
    for _ in range(400):
        a, n = rnd.choice(letters), rnd.choice([1, 3, 10, 50, 200, 700])
        w = "".join(rnd.choice(a) for _ in range(n))
        out.append(w[:n // 2] + rnd.choice(["<|endoftext|>", " <|startoftext|> ", "<|endof", "'s 're", " "]) + w[n // 2:] if rnd.random() < 0.3 else w)
    return out


def test_encoding_and_decoding_match_the_library(library):
    c = Coder(PATH, cache=50)           # small: entries come and go
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for t in texts():
        e = library.encode(t, add_special_tokens=False)
        assert list(c.encode(t)) == e.ids
        text = library.decode(e.ids, skip_special_tokens=False)
        assert "".join(c.decode(e.ids)) == text
        assert c.digests(t.encode()) == (len(e.ids), sha(" ".join(map(str, e.ids))), sha(text))


def test_readable_text_state_machine():
    c = Coder(PATH)
    assert "".join(c.text(c.encode("Ein Wörtchen 中文😀 <|endoftext|> ok"))) == "ein wörtchen 中文 😀 <|endoftext|>ok "
    first = next(i for i, t in c.text_of.items() if t == c.symbol[0xE4])        # an unfinished character
    assert "".join(c.text([first])) == "�"


def test_stream_needs_little_memory(library):
    """A word of 160,000 letters: tokens come out while it is read, in order, and equal the library's."""
    c, read, most = Coder(PATH), 0, 0
    word = "".join(random.Random(9).choice("abcdefgh") for _ in range(4000)) * 40
    out = []

    def symbols():
        nonlocal read
        for s in c.symbols(word):
            read += 1
            yield s

    emitted = 0
    for t in c.stream(symbols()):
        most = max(most, read - emitted)
        emitted += len(c._parts(t))
        out.append(c.ids[t])
    assert out == library.encode(word, add_special_tokens=False).ids
    assert most < 20 * c.lookahead


def test_counts_match_the_library(library):
    whole, small = Counter(PATH), Counter(PATH, chunk=60, overlap=4, cache=20)
    for t in [*texts(), "x" * 5000 + " y", "word " * 4000 + "z" * 3000 + " end"]:
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert whole.many([t.encode()]) == [n]
        assert small.many([t.encode()]) == [n]
        assert small.spliced(t) == n
    assert small.widened > 0


def test_huge_texts_without_white_space(library, monkeypatch):
    """Ideographs, mixed classes, contractions, special strings and marks in one run: no piece far over a chunk."""
    rnd, sizes = random.Random(5), []
    starts = Counter._starts
    monkeypatch.setattr(Counter, "_starts", lambda self, text, a, b: sizes.append(b - a) or starts(self, text, a, b))
    han = "".join(chr(rnd.randrange(0x4E00, 0x9FA5)) for _ in range(20_000))
    kana = "".join(rnd.choice("あいうえおがぎカキクーン゙한국어ไทยก็") for _ in range(6000))
    mixed = "".join(rnd.choice(["中", "a", "b1", "'re", "!'t", "'", "<|endoftext|>", "<|", "é", "e\u0301", "😀", "。", "Don't", "Σ", "\u0301", "-", "x"]) for _ in range(6000))
    for t, most in ((han, 400), (kana, 2000), (mixed, 400)):
        sizes.clear()
        assert Counter(PATH, chunk=100, overlap=16).spliced(t) == len(library.encode(t, add_special_tokens=False).ids)
        assert max(sizes) < most and sum(sizes) < 4 * len(t)


def test_every_stable_place_splits_the_encoding(library):
    """Cutting a text at any place called stable changes no token (a word's end symbol aside)."""
    c, rnd, seen = Counter(PATH), random.Random(6), 0
    parts = ["中", "文字", "あ", "か\u3099", "한", "a", "q", "zx", "jq", "7", "'re", "'", "!", "'t", "<|endoftext|>", "<|endof", "e\u0301", "😀", "。", " ", "\u00a0", "Ⅷ"]
    for _ in range(600):
        t = "".join(rnd.choice(parts) for _ in range(12))
        e = library.encode(t, add_special_tokens=False)
        places = [s for s, _ in e.offsets]
        for x in range(1, len(t)):
            if c.stable(t, x):
                seen += 1
                assert x in places
                k = places.index(x)
                for a, b in ((t[:x], t[x:] + rnd.choice(parts)), (rnd.choice(parts) + t[:x], t[x:])):
                    other = library.encode(a + b, add_special_tokens=False)
                    at = [s for s, _ in other.offsets].index(len(a))
                    if a == t[:x]:
                        assert other.ids[:at] == e.ids[:k]
                    else:
                        assert other.ids[at:] == e.ids[k:]
    assert seen > 1000


def frame(spark):
    rows = [(i % 300, t, "x", "y") for i, t in enumerate(t for t in texts() if "\x00" not in t)] + [(None, "a b", "", ""), (7, None, "", "")]
    return spark.createDataFrame(rows, SCHEMA), rows


def test_queries(spark, library):
    d, rows = frame(spark)
    enc = [(i, (t or "").encode(), library.encode(t or "", add_special_tokens=False).ids) for i, t, *_ in rows]
    got = token_counts(d, PATH, limit=100).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, len(t), len(e), len(e) > 100) for i, t, e in enc), key=str)
    got = round_trip(d, PATH).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(i, len(e), sha(" ".join(map(str, e))), sha(library.decode(e, skip_special_tokens=False))) for i, _, e in enc]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts(d.limit(0), PATH).collect() == [] == round_trip(d.limit(0), PATH).collect()


def test_every_word_goes_through_transducer_and_decoder(monkeypatch):
    """Digests come from the transducer's ids by way of the decoder, for short words, long ones and special strings."""
    c, words, decoded = Coder(PATH), [], []
    stream, decode = c.stream, c.decode
    monkeypatch.setattr(c, "stream", lambda s: words.append(s) or stream(s))
    monkeypatch.setattr(c, "decode", lambda ids: decoded.append(list(ids)) or decode(decoded[-1]))
    n, _, _ = c.digests(("some short words " + "x" * 500 + " and more <|endoftext|> words").encode())
    assert len(words) == 6 and sum(map(len, decoded)) == n - 1         # "words" is remembered


def test_texts_are_read_in_blocks(library, monkeypatch):
    from pasture.llm import bpe_transducer as B
    monkeypatch.setattr(B, "BLOCK", 64)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rnd = random.Random(2)
    long = ["中文字符" * 90 + " end", "a b " * 100, "w" * 300, " " * 200 + "x", "!?" * 100 + "\n" * 80 + "é" * 70, "x1y2" * 50 + "<|endoftext|>" + "z" * 90]
    for t in long + [rnd.choice([" ", ""]).join(rnd.choice(texts()) for _ in range(5)) for _ in range(20)]:
        c = Coder(PATH)
        e = library.encode(t, add_special_tokens=False)
        assert c.digests(t.encode()) == (len(e.ids), sha(" ".join(map(str, e.ids))), sha(library.decode(e.ids, skip_special_tokens=False)))
        assert b"".join(c._blocks(t.encode())) == t.encode()

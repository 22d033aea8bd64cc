"""Vectorised text kernels against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa

from stratiform.llm import tokens
from stratiform.llm.docstats import Stats
from stratiform.llm.html_text import main_text, page_blocks, repeated
from stratiform.llm.textkit import LOWER, NON_SPACE, Words, byte_hashes, chunks, span_hashes, window_hashes


def _texts(seed, n=300):
    r = random.Random(seed)
    odd = [None, "", " ", "\n\n", "a", "é" * 400, "x" * 1000 + " y", "<|endoftext|> a", "it's  he'll b", "a　b c"]
    return odd + ["".join(r.choice(" ab1é\n\t!'sZ日#* —") for _ in range(r.randint(0, 90))) for _ in range(n)]


def test_words_and_hashes_agree_with_split():
    texts = _texts(1)
    for limit in (1, 100, 1 << 20):
        got = []
        for chunk in chunks(pa.array(texts), limit):
            words = Words(chunk, NON_SPACE, LOWER)
            raw = [words.data[a:b].tobytes() for a, b in zip(words.start, words.stop)]
            hashed = words.hashes()
            assert len(set(raw)) == len(set(hashed.tolist()))
            got += [raw[a:b] for a, b in zip(words.begin, words.end)]
        want = [re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())) for t in texts]
        assert got == want


def test_hashes_depend_on_contents_and_length_alone():
    data = np.frombuffer(b"abcabcab" * 60 + b"abcabcab" * 60, np.uint8)
    start, stop = np.array([0, 480, 0, 3]), np.array([480, 960, 3, 6])
    for h in (byte_hashes(data, start, stop), span_hashes(data, start, stop)):
        assert h[0] == h[1] and h[2] == h[3] and h[0] != h[2]
    words = np.array([5, 6, 7, 5, 6, 8], np.uint64)
    assert window_hashes(words, 2)[0] == window_hashes(words, 2)[3]
    assert len(window_hashes(words, 7)) == 0


def test_piece_encoder_equals_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = _texts(2, 800) + ["see <|endoftext|> here", "<|endoftext|>", "a<|endoftext", "|>b", "The same words, the same pieces. " * 300]
    want = [x.ids for x in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    encode = tokens.Encoder(tokens.tokenizer_path())
    for _ in range(2):          # with an empty and a filled store
        assert [x.tolist() for x in encode.encode_column(pa.array(texts))] == want


def test_statistics_against_plain_python():
    from collections import Counter
    texts = _texts(3) + ["a b c a b c", "x\nx\n\n \nx y\nx", "l\r\nl\r\n", "w " * 200]
    got = [tuple(int(v[i]) for v in (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words))
           for c in chunks(pa.array(texts)) for s in [Stats(c)] for i in range(len(c))]

    def plain(t):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        tri, covered, seen, dup = Counter(zip(w, w[1:], w[2:])), set(), set(), 0
        for i in range(len(w) - 2):
            if tri[tuple(w[i:i + 3])] > 1:
                covered |= {i, i + 1, i + 2}
        for line in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered)
    assert got == [plain(t) for t in texts]


def test_repeats_against_all_windows():
    r = random.Random(4)
    for run in (1, 2, 3, 5, 8):
        docs = [[r.randint(0, 2) for _ in range(r.randint(0, 30))] for _ in range(7)]
        where = {}
        for i, t in enumerate(docs):
            for k in range(len(t) - run + 1):
                where.setdefault(tuple(t[k:k + run]), set()).add(i)
        want = [any(0 <= a <= len(t) - run and len(where[tuple(t[a:a + run])]) > 1 for a in range(k - run + 1, k + 1))
                for t in docs for k in range(len(t))]
        flat = np.array(sum(docs, []), dtype=np.uint64)
        assert repeated(flat, np.repeat(np.arange(7), [len(x) for x in docs]), run).tolist() == want


def test_blocks_of_broken_markup():
    page = ("<!doctype html><html><head><title>T</title><style>p{}</style></head><body><nav><a href='>'>m</a></nav>"
            "<header><h1>Site</h1></header><div class='side-bar cookie'>c</div><article><header><h1>A &amp; B</h1></header>"
            "<p><b>one<br>two<p>three <script>if (a<b) x='</p>'</script>four<div class=\"ad\">buy</div><ul><li>x<li>y</ul>"
            "<section id=comments><p>first!</p></section></article><form>f</form><!-- c --><footer>&copy; 1</footer><p>tail &am")
    assert main_text(page_blocks(page), None).split("\n") == ["A & B", "one two", "three four", "x", "y"]
    assert page_blocks(None) == page_blocks("") == []
    assert main_text(page_blocks("<p>a < b<p>c<"), np.zeros(9, bool)) == "a < b\nc<"
    assert main_text(page_blocks("<main><p>a</p></main><p>out</p>"), None) == "a"


def test_unique_words_pick_the_container():
    def covered(*some):
        return np.array([c == "x" for c in "".join(some)])
    page = page_blocks("<div>m e n u</div><p>the story is here</p><article>read more</article>")
    assert main_text(page, covered("xxxx", "....", "..")) == "the story is here\nread more"
    assert main_text(page, covered("xxxx", "xxxx", "..")) == "read more"
    assert main_text(page, covered("xxxx", "xx..", "xx")) == "the story is here\nread more"


def test_markup_keeps_the_text_that_a_wrapper_holds():
    story = "a long story of more words than the rest"
    for page in ("<div class='layout has-sidebar'><article>{}</article></div>", "<article class='post comments-open'><p>{}</p></article>",
                 "<body><form><nav>m</nav><article>{}</article></form>", "<nav><a>home</a><article><p>{}</article>", "<article><form>{}</form></article>",
                 "<div class=sidebar><div class=widget><article>{}</article></div></div><div class='site-footer'>f</div>",
                 "<form><p>{}</p></form>", "<article><p class=commentary>{}</article>", "<article><h2 id=related>{}</h2></article>",
                 "<article><p>{}<section id=comments><article class=comment>" + "c " * 40 + "</article></section></article>"):
        assert main_text(page_blocks(page.format(story)), None) in (story, "home\n" + story), page
    assert main_text(page_blocks("<main><p>story</p><article>teaser</article></main>"), None) == "story\nteaser"
    assert main_text(page_blocks("<main><p>a longer story</p><aside><article>teaser</article></aside></main>"), None) == "a longer story"
    for name in ("ad", "comments", "site-footer", "cookie-notice box", "comment-list"):
        assert main_text(page_blocks(f"<p>a b c d</p><div class='{name}'>e f</div>"), None) == "a b c d", name
    assert main_text(page_blocks("<article>a</article><footer>b c d e f</footer><nav>g h i</nav>"), None) == "a"


def test_encoder_on_long_runs_and_special_strings():
    import public_tokenizers
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    n = 1_000_000
    texts = [" " * n, "\n" * n, "a plain text", "\t \n" * 50_000 + "end <|endoftext|>", "<|endoftext|>" * 3 + " x", None, "x" * 30_000 + " y",
             "日本" * 9_000, "cut <|endof", "text|> there", "word" * (n // 4)]
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    encode = tokens.Encoder(tokens.tokenizer_path())
    assert [x.tolist() for x in encode.encode_column(pa.array(texts))] == want
    assert encode.ids(b"see <|endoftext|> here").tolist() != encode.whole(b"see <|endoftext|> here").tolist() == [3826, 220, 50256, 994]

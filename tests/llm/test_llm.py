"""Operators on text against brute force, exact round trips and small known cases."""

import os
import random
import time
import unicodedata

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("brookweave.llm")

from brookweave.llm import encoding, leakage, quality, queries, text, units  # noqa: E402
from brookweave.session import table  # noqa: E402

VOCABULARY = queries.vocabulary()
needs_vocabulary = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary file here")

TEXTS = [
    None, "", " ", "\n\n \t x", "Hello world, it's 2024!", "the the  the   the", "Xin chào các bạn, khoản vay quá hạn", "é", "é", "🙏🏽 ok →★",
    "a" * 300, "=" * 1000, "I'll we've he'd DON'T ' s", "１２３ ｗｉｄｅ", "\x00\x01\x7f", "ᄀ각 한국어 中文字符", "x" + " " * 50 + "y", "  nb　sp",
    "Zq9" * 40, "tab\tline\r\nend ", "ﬁ ß ſ İ",
]


@needs_vocabulary
def test_encoding_matches_the_library_and_decodes(spark):
    tiktoken = pytest.importorskip("tiktoken")
    rng = random.Random(2)
    alphabet = "abc ABC 012 .,'\n\tđầéß中🙂="
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(150)]
    df = spark.createDataFrame([(i, t, "ids") for i, t in enumerate(texts)], "doc_id int, text string, ids string")
    got = encoding.decode_ids(encoding.encode_corpus(df, "doc_id", "text", VOCABULARY), "ids", VOCABULARY).collect()
    pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    codec = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=dict(encoding.load_ranks(VOCABULARY)), special_tokens={})
    assert len(got) == len(texts)
    for r in got:
        assert r.ids == codec.encode_ordinary(texts[r.doc_id] or ""), repr(texts[r.doc_id])
        assert r.decoded == (texts[r.doc_id] or "")


@needs_vocabulary
def test_long_words_and_rulers(spark, monkeypatch):
    tiktoken = pytest.importorskip("tiktoken")
    rng = random.Random(6)
    pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    ranks = dict(encoding.load_ranks(VOCABULARY))
    codec = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    for n in (1, 2, 3, 50, 700):
        word = "".join(rng.choice("aábcde") for _ in range(n))
        assert encoding.merged_bytes(word.encode(), ranks) == codec.encode_ordinary(word)
    assert encoding.merged_bytes(b"a" * 1001, ranks) == codec.encode_ordinary("a" * 1001)
    long = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000))
    texts = [long, "=" * 300 + " x " + "-" * 3000, "=" * 300, "z" * 600 + " " + "q" * 511]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    began = time.time()
    got = {r.doc_id: r.ids for r in encoding.encode_corpus(df, "doc_id", "text", VOCABULARY).collect()}
    assert got == {i: codec.encode_ordinary(t) for i, t in enumerate(texts)} and time.time() - began < 60


@needs_vocabulary
def test_encoding_keeps_repeated_and_null_ids_and_rare_words(spark, monkeypatch):
    monkeypatch.setattr(encoding, "HOT_WORDS", 1)
    df = spark.createDataFrame([(1, "Quanghel Torvane"), (1, "Quanghel"), (None, "Zanbri Torvane")], "doc_id int, text string")
    got = sorted((r.doc_id or 0, len(r.ids)) for r in encoding.encode_corpus(df, "doc_id", "text", VOCABULARY).collect())
    assert [g[0] for g in got] == [0, 1, 1] and all(n > 0 for _, n in got)
    assert encoding.encode_corpus(df.where("false"), "doc_id", "text", VOCABULARY).count() == 0


def naive(corpus, items, span):
    found = set()
    for d, t in corpus:
        for i, x in items:
            w = text.words(x or "")
            grams = {tuple(w[j : j + span]) for j in range(len(w) - span + 1)}
            for reading in text.readings(t or "", set(w)):
                if any(tuple(reading[j : j + span]) in grams for j in range(len(reading) - span + 1)):
                    found.add((d, i))
    return found


def test_leakage_against_brute_force(spark):
    rng = random.Random(4)
    vocab = ["ăn", "Dog", "cat", "x1", "ngày", "red", "don't", "7", "Đi", "sun"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(2, 25)))) for i in range(12)] + [(98, None), (99, "")]
    corpus = [(d, " ".join(rng.choice(vocab + ["zzz"]) for _ in range(rng.randrange(60)))) for d in range(120)]
    for d in range(200, 240):
        source = rng.choice(items[:12])[1]
        corpus.append((d, f"zzz, {rng.choice([str.upper, str.lower, str.title])(source).replace(' ', rng.choice([' ', '  ', chr(10), ', ', ' <b>']))} zzz"))
    corpus += [(300, None), (301, ""), (302, corpus[150][1]), (302, corpus[150][1])]
    docs = spark.createDataFrame([(*c, "x") for c in corpus], "doc_id int, text string, item_id string")
    tests = spark.createDataFrame(items, "item_id int, t string")
    for shard, block in ((10_000, 100), (40, 5)):
        spans = leakage.leaked_spans(docs, "doc_id", "text", tests, "item_id", "t", span=5, shard=shard, item_block=block)
        assert {(r.doc_id, r.item_id) for r in leakage.leaked_items(spans).collect()} == naive(corpus, items, 5)
    assert leakage.leaked_spans(docs, "doc_id", "text", tests.where("false"), "item_id", "t").count() == 0
    assert leakage.leaked_spans(docs.where("false"), "doc_id", "text", tests, "item_id", "t").count() == 0


def test_spans_are_merged(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h zz a b c d")], "d int, t string")
    tests = spark.createDataFrame([(7, "a b c d e f g")], "i int, t string")
    got = [(r.start_word, r.end_word) for r in leakage.leaked_spans(docs, "d", "t", tests, "i", "t", span=4).orderBy("start_word").collect()]
    assert got == [(0, 7), (9, 13)]


def test_index_counts_and_locates():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 4, 500).astype(np.int32)
    index = leakage.FmIndex(codes, 3)
    for m in (1, 2, 3, 5):
        phrases = rng.integers(1, 4, (20, m)).astype(np.int32)
        low, high = index.search(phrases)
        for p, a, b in zip(phrases, low, high):
            want = [i for i in range(len(codes) - m + 1) if (codes[i : i + m] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_reading_text():
    assert text.words("<p>Đường&nbsp;d&agrave;i</p><b>A</b>bc é ﬁn​al don't") == ["duong", "dai", "abc", "e", "final", "don", "t"]
    assert text.readings("arrange-\n> ment of co-\noperative", {"arrangement"}) == [["arrangement", "of", "co", "operative"], ["arrange", "ment", "of", "co", "operative"]]
    assert text.words("a&amp;amp;amp;lt;b&amp;amp;amp;gt;c &amp;amp;amp;nbsp;d") == ["ac", "d"]
    assert text.readings("plain text", set()) == [["plain", "text"]]


def measure(text):
    row, size, stats = units.unit_statistics(pa.array([text]), units.common_hashes(COMMON))
    return [dict(zip(units.FEATURES, s), size=n) for n, s in zip(size, stats)]


def test_markup_of_any_length():
    long = "x y " * 2000
    for tag in (f'<a href="{long}">', f"<p style='{long}'>", '<my-tag class="k">', "</my-tag>", '<svg:path d="M 0">', f"<{'n' * 40}>", f"<a href={'z' * 9000}>", f"<a href = '{long}' >", f"<!-- {long} -->", "<!-- <b>a</b> <p> -->", "<!-->", "<p-note id='1'>"):
        assert text.words(f"one {tag} two") == ["one", "two"], tag[:40]
    assert text.visible("a<my-tag>b</my-tag>c<p-x>d") == "abcd" and text.visible("a<p class='k'>b<br/>c") == "a\nb\nc"
    assert text.words("2 < 3 and 5 > 4 <!-- no end") == ["2", "3", "and", "5", "4", "no", "end"]
    assert len(measure(f"The loan was paid.<p style='{long}'>The card was not.")) == 2
    began = time.process_time()
    for hostile in ("<a " * 300_000, "<!--" * 300_000, "<p " + "x" * 1_000_000, "<" + "a-" * 500_000, "<!-- -- " * 100_000, "<a " + "x=1 " * 300_000 + "<", "<a " + "= " * 300_000 + ">"):
        text.visible(hostile)
    assert time.process_time() - began < 10


def test_leak_around_long_tags(spark):
    words = [f"word{k}" for k in range(20)]
    href = "/".join(f"part{k}" for k in range(60))
    docs = [(1, " ".join(words[:10]) + f' <a href="{href}">' + " ".join(words[10:]) + "</a>"), (2, " ".join(words[:10]) + f" <!-- {'note ' * 600}--> " + " ".join(words[10:]))]
    docs += [(3, " ".join(words[:10]) + ' <my-tag class="k"> ' + " ".join(words[10:])), (4, " ".join(words[:10]) + " other " + " ".join(words[10:]))]
    docs += [(5, "where x <y note " + "other " * 40 + " ".join(words) + " and z > 3")]
    corpus, items = spark.createDataFrame(docs, "d int, t string"), spark.createDataFrame([(7, " ".join(words))], "i int, t string")
    spans = leakage.leaked_spans(corpus, "d", "t", items, "i", "t")
    assert {r.doc_id for r in leakage.leaked_items(spans).collect()} == {1, 2, 3, 5}


COMMON = ["the", "a", "and", "of", "for", "it", "was", "had", "that", "to", "in", "on", "is", "và", "của", "cho", "đã", "vì"]


def test_units_of_a_text():
    found = measure("The dog was\n- the cat\n12) Một con mèo\n\n| a | b |\n<p>Đã &agrave; v&#236;.</p> <li>x")
    assert [u["size"] for u in found] == [9, 7, 12, 5, 6, 2]
    assert [u["marker"] for u in found] == [0, 1, 1, 0, 0, 1]
    assert [u["ends_sentence"] for u in found] == [0, 0, 0, 0, 1, 0]
    assert found[0]["common_share"] == pytest.approx(2 / 3) and found[4]["common_share"] == 1
    assert found[3]["cells"] == pytest.approx(1.5) and found[0]["log_block_lines"] == pytest.approx(np.log1p(3))
    wrapped = "The clerk wrote a note about the\nbalance of the loan, and the customer\nasked for it twice."
    assert len(measure(wrapped)) == 1 and len(measure("> " + wrapped.replace("\n", "\n> "))) == 1
    assert len(measure("- the savings account of the firm\n- the card of the other unit there")) == 2
    assert measure("")[:] == measure(None) == measure(" \n\t ") == []


def test_units_do_not_depend_on_the_batch_or_on_letter_forms(monkeypatch):
    rng = random.Random(9)
    texts = [None, *TEXTS, *["".join(rng.choice("ab the. \n-|1đầ🙂—") for _ in range(rng.randrange(80))) for _ in range(200)]]
    common = units.common_hashes(COMMON)
    row, size, stats = units.unit_statistics(pa.array(texts), common)
    for i, t in enumerate(texts):
        alone = units.unit_statistics(pa.array([t]), common)
        assert size[row == i].tolist() == alone[1].tolist() and np.allclose(stats[row == i], alone[2]), repr(t)
    accented = "Khách hàng đã gửi giấy tờ, vì lãi suất đã thay đổi."
    same = [measure(unicodedata.normalize(form, accented)) for form in ("NFC", "NFD", "NFKD")]
    assert same[0] == same[1] == same[2]
    long = "The clerk had a note for the loan.\n" * 400
    whole = units.unit_statistics(pa.array([long, "x"]), common)
    monkeypatch.setattr(units, "CHUNK", 1000)
    parts = units.unit_statistics(pa.array([long, "x"]), common)
    assert whole[0].tolist() == parts[0].tolist() and whole[1].tolist() == parts[1].tolist()


def test_words_are_counted_like_a_plain_loop():
    rng = random.Random(1)
    for _ in range(100):
        line = "".join(rng.choice("ab the éĐ1 ,.") for _ in range(40)) + "."
        got = measure(line)
        found = text.WORD.findall(text.fold(unicodedata.normalize("NFKD", line)))
        if got and not got[0]["marker"]:
            known = {text.fold(w) for w in COMMON}
            assert np.expm1(got[0]["log_words"]) == pytest.approx(len(found))
            assert got[0]["common_share"] == pytest.approx(sum(w in known for w in found) / max(1, len(found)))


KINDS = {
    "poem": (True, "Before the frost had touched the lane\nwe walked it in the evening light,\nand all the fields were gold with grain\nthat leaned together for the night."),
    "dialogue": (True, "\"Are you coming?\" she asked.\n\"In a minute,\" he said, and went back to the letter that was on the desk."),
    "story": (True, "The old man had not been to the sea for years. When he saw it again, he sat down on a stone and did not speak until it was dark."),
    "vietnamese": (True, "Chiều hôm ấy trời đã tạnh mưa, và chúng tôi đi bộ ra bờ sông để xem người ta thả đèn. Không ai nói gì cho đến khi về nhà."),
    "bullets": (False, "- blue paint\n- two brushes\n- masking tape\n- old newspapers\n- ladder"),
    "csv": (False, "1001,2022-05-01,19.99,EUR\n1002,2022-05-02,5.00,USD\n1003,2022-05-02,,EUR\n1004,2022-05-03,7.25,GBP"),
    "markdown": (False, "| item | qty | price |\n| --- | --- | --- |\n| bolt | 12 | 0.40 |\n| nut | 30 | 0.10 |"),
    "log": (False, "level=debug msg=opened pid=991 file=/var/lib/x.db\nlevel=error msg=denied pid=991 code=13 user=root\nlevel=info msg=closed pid=991"),
    "mash": (False, "fdgkj wrtpl zxcvb qwrty hgfds mnbvc plkjh trwqz xcvbn kjhgf dsqwr tplkm nbvcx"),
    "trace": (False, "java.io.IOException: Broken pipe\n    at sun.nio.ch.FileDispatcherImpl.write0(Native Method)\n    at sun.nio.ch.SocketDispatcher.write(SocketDispatcher.java:47)\n    at io.netty.channel.socket.nio.NioSocketChannel.doWrite(NioSocketChannel.java:405)"),
    "hex": (False, "7f 45 4c 46 02 01 01 00 00 00 00 00 00 00 00 00 03 00 3e 00 01 00 00 00 c0 0a 00 00"),
}


def test_kinds_of_text_that_no_table_holds(spark, sf):
    """Fitted on the tables' documents, judged on texts that are none of theirs."""
    documents = table(spark, "/root/testdata/sf0.01" if os.path.exists("/root/testdata/sf0.01") else sf, "documents").select("doc_id", "text")
    extra = spark.createDataFrame([(-1 - i, t) for i, (_, t) in enumerate(KINDS.values())], "doc_id bigint, text string")
    classes = quality.document_classes(documents.unionByName(extra), "doc_id", "text", queries.common_words(spark, sf))
    other = {r.doc_id for r in quality.not_prose(classes).where("doc_id < 0").collect()}
    wrong = [k for i, (k, (prose, _)) in enumerate(KINDS.items()) if prose == (-1 - i in other)]
    assert wrong == []


def test_documents_that_are_no_prose(spark):
    prose = "The clerk wrote a note about the balance, and the customer asked for it twice because the rate had moved."
    grid = "| a | b | c |\n| --- | --- | --- |\n" + "| 1 | 2 | 3 |\n" * 30
    docs = [
        (1, prose), (2, prose.upper()), (3, grid), (4, prose + "\n" + grid), (5, grid + "\n\n" + (prose + " ") * 8), (6, None), (7, ""), (8, " \n "),
        (9, "- the loan\n- the card unit\n- LND.1234\n" * 5), (10, "4f 8a 99 00 12 4f 8a 99 00 12 4f 8a 99 00 12"), (11, "word " * 5000), (None, grid), (3, grid),
    ]
    df = spark.createDataFrame([(*d, 1.0) for d in docs], "doc_id int, text string, n_visible double")
    classes = quality.document_classes(df, "doc_id", "text", COMMON).cache()
    assert classes.count() == len(docs)
    rows = {r.doc_id: r for r in classes.collect()}
    assert {r.doc_id for r in quality.not_prose(classes).collect()} >= {3, 4, 9, 10, None}
    assert rows[1].prose_share > 0.5 and rows[2].prose_share > 0.5
    assert rows[6].prose_share is None and rows[8].junk_share is None and rows[1].n_visible == len(prose.replace(" ", ""))
    assert sum(rows[3][f"{c}_share"] for c in quality.CLASSES) == pytest.approx(1)
    assert quality.document_classes(df.where("false"), "doc_id", "text", COMMON).count() == 0


def test_mixture_of_cells_is_the_mixture_of_units():
    rng = np.random.default_rng(0)
    d = len(units.FEATURES)
    a, b = rng.normal(0, 1, (3000, d)), rng.normal(4, 1, (3000, d))
    x = np.vstack([a, b])
    cell = np.floor(x[:, 0] * 2).astype(int) * 100 + np.floor(x[:, 1] * 2).astype(int)
    _, index, n = np.unique(cell, return_inverse=True, return_counts=True)
    total = lambda y: np.stack([np.bincount(index, c) for c in y.T], axis=1)
    model = quality.fit_mixture(n.astype(float), total(x), total(x**2), components=2, splits=0)
    means = sorted(float((model.means[k] * model.scale + model.centre).mean()) for k in range(2))
    assert means == pytest.approx([0, 4], abs=0.1)
    quality.name_components(model, np.vstack([a[:50], b[:50]]), np.repeat([0, 1], 50))
    assert (model.class_shares(a)[:, 0] > 0.9).mean() > 0.99 and (model.class_shares(b)[:, 1] > 0.9).mean() > 0.99


def test_text_statistics(spark):
    df = spark.createDataFrame([(1, "The cat sat.\nA dog #ran\n\n"), (2, None), (3, " ")], "doc_id int, text string")
    rows = {r.doc_id: r for r in quality.text_statistics(df, "doc_id", "text", COMMON).collect()}
    assert (rows[1].n_words, rows[1].n_lines, rows[1].ended_lines_share) == (6, 2, 0.5)
    assert rows[1].mean_word_length == pytest.approx(16 / 6) and rows[1].common_share == pytest.approx(2 / 6)
    assert rows[1].symbol_share == pytest.approx(2 / 18)
    assert (rows[2].n_words, rows[2].mean_word_length, rows[3].symbol_share) == (0, None, None)


def test_queries_run_on_small_tables(spark, sf):
    for name, query in queries.QUERIES.items():
        assert query(spark, sf).count() > 0, name

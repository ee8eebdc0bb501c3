"""Every operator and stage on odd rows, and on empty tables."""

import hashlib

import pytest

import corpus_pipeline
from hitlist.llm import chat, decontaminate, html, licenses, neardup, packing, pii, quality, substrings, token_counts
from hitlist.llm.shared import public_tokenizer
from tests.llm.conftest import CLASHES, bag, lines, words

BYTE, WORD = public_tokenizer("byte_bpe_50k.json"), public_tokenizer("word_bpe_49k.json")


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, lines(7, 14)), (2, None), (3, ""), (None, lines(6, 11)), (4, "Tie TIE"), (4, "Tie TIE")]
    return spark.createDataFrame(rows, "item_id long, text string")


REPORTS = {
    "neardup": lambda d, b: neardup.links(d),
    "tokens": lambda d, b: token_counts.token_counts(d, WORD),
    "substrings": lambda d, b: substrings.report(d),
    "decontaminate": decontaminate.contamination,
    "packing": lambda d, b: packing.pack_documents(d, (BYTE,)),
    "licenses": lambda d, b: licenses.scan(d),
    "quality": lambda d, b: quality.judge(d),
}


@pytest.mark.parametrize("name", REPORTS)
def test_empty_tables(spark, empty, name):
    assert REPORTS[name](empty, spark.createDataFrame([], "item_id long, text string")).count() == 0


@pytest.mark.parametrize("name", [n for n in REPORTS if n != "packing"])
def test_one_row_a_row(odd, bench, name):
    made = REPORTS[name](odd, bench)
    assert bag(made, "doc_id") == bag(odd, "doc_id")


def test_neardup(odd):
    got = {(r.doc_id, r.class_id, r.n_links, r.n_copies) for r in neardup.links(odd).collect()}
    # 1 and 9 are copies, as are the two rows of 5, which is one document; without words or id nothing links
    assert {(1, 1, 1, 2), (9, 1, 1, 2), (2, 2, 0, 1), (3, 3, 0, 1), (8, 8, 0, 1), (None, None, 0, 1)} <= got
    kept = neardup.keep_one(odd)
    assert kept.columns == odd.columns and 9 not in {r.doc_id for r in kept.collect()}
    assert kept.filter("doc_id IS NULL").count() == 2


def test_tokens(odd):
    from hitlist.llm.shared import load_tokenizer

    tok = load_tokenizer(WORD)
    want = {}
    for r in odd.collect():
        t = r.text or ""
        n = len(tok.encode(t, add_special_tokens=False))
        want.setdefault((r.doc_id, len(t.encode()), n, n > 2048), 0)
        want[(r.doc_id, len(t.encode()), n, n > 2048)] += 1
    assert bag(token_counts.token_counts(odd, WORD), "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def test_substrings(odd):
    got = {(r.doc_id, r.n_words, r.n_removed) for r in substrings.report(odd).collect()}
    # a row without an id is kept whole and takes nothing from others; repeats of a row don't either
    assert {(1, 140, 0), (9, 140, 140), (5, 140, 80), (2, 0, 0), (8, 0, 0), (None, 80, 0)} <= got
    kept = substrings.remove(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts[5] == lines(5, 60) and texts[9] == "" and texts[2] is None


def test_decontamination(odd, bench):
    got = {(r.doc_id, r.n_words, r.n_hit, r.n_items) for r in decontaminate.contamination(odd, bench).collect()}
    # an item without an id hits but isn't listed; a short item is one window
    assert {(1, 140, 14, 1), (6, 70, 11, 0), (10, 3, 3, 1), (2, 0, 0, 0), (None, 80, 14, 1), (None, 0, 0, 0)} <= got
    for limit in (0, 1 << 20):  # joined by a shuffle, and broadcast
        left = decontaminate.remove(odd, bench, max_share=0.2, broadcast_bytes=limit)
        assert left.columns == odd.columns
        texts = {(r.doc_id, r.text) for r in left.collect()}
        assert (10, "tie tie tie") not in texts and (2, None) in texts
        assert decontaminate.contamination(left, bench).filter("contaminated").count() == 0


def test_packing(odd):
    rows = packing.pack_documents(odd, (BYTE,)).collect()
    check_packing(rows)
    assert sum(r.piece == 0 for r in rows) == odd.count()
    assert {(r.length, r.start) for r in rows if r.doc_id in (2, 3)} == {(1, 0)}


def check_packing(rows):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_quality(odd):
    got = {(r.doc_id, r.n_words, r.base_failed, r.kept) for r in quality.judge(odd).collect()}
    assert {(1, 140, False, True), (2, 0, True, False), (3, 0, True, False), (10, 3, True, False)} <= got
    good = quality.keep_good(odd)
    assert good.columns == odd.columns and {r.doc_id for r in good.collect()} <= {1, 4, 5, 6, 9, None}


def test_licenses(odd):
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.score) for r in licenses.scan(odd).collect()}
    assert got[2] == (0, 0, None, 0.0) and got[10] == (3, 0, None, 0.0)


def test_pii(odd, empty):
    key = "k"
    assert pii.replace(empty, key).count() == 0
    same = pii.replace(odd, key)
    assert same.columns == odd.columns
    assert bag(same, "doc_id", "text") == bag(odd, "doc_id", "text")
    more = odd.unionByName(odd.filter("doc_id = 5").selectExpr("*").replace(lines(5, 60), "x"))
    assert pii.replace(more, key).count() == more.count()


def test_html(spark):
    kind = "page_id long, url string, html string, low string, host string"
    pages = spark.createDataFrame(
        [(1, None, "<p>a&amp;b", "x", "y"), (2, "http://h/", None, None, None), (None, "no url", "", "x", "y"),
         (3, "http://h/1", "<p>" + "word " * 50_000 + "<footer>f", "x", "y"), (3, "http://h/1", "plain <b>te</b>xt", "x", "y")],
        kind,
    )
    got = bag(html.extract(pages), "page_id", "text", "n_chars")
    long = " ".join(["word"] * 50_000)
    assert got == {(1, "a&b", 3): 1, (2, "", 0): 1, (None, "", 0): 1, (3, long, len(long)): 1, (3, "plain text", 10): 1}
    assert html.extract(spark.createDataFrame([], kind)).count() == 0


def test_chat(spark):
    kind = "conv_id long, turn long, role string, text string, part string, formatted string"
    rows = [
        (1, 0, "user", None, "x", "y"), (1, 1, "assistant", "", "x", "y"), (1, 2, None, "<|end|>\\", "x", "y"),
        (1, 2, "assistant", "é<|text|>\n" * 3, "x", "y"), (1, 2, "assistant", "é<|text|>\n" * 3, "x", "y"),
        (None, None, "assistant", "lost", "x", "y"), (2, None, "assistant", "x" * 200_000 + "<", "x", "y"),
    ]
    got = {r.conv_id: r for r in chat.digests(spark.createDataFrame(rows, kind), BYTE).collect()}
    text = "é<|text|>\n" * 3
    turns = [("user", ""), ("assistant", ""), ("", "<|end|>\\"), ("assistant", text), ("assistant", text)]
    want = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert got[1].turns_sha256 == want and got[1].n_turns == 5
    assert got[1].loss_sha256 == hashlib.sha256((text * 2).encode()).hexdigest() and got[1].loss_chars == 2 * len(text)
    assert got[2].loss_chars == 200_001 and got[None].loss_chars == 4
    assert chat.digests(spark.createDataFrame([], kind), BYTE).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, odd, empty, bench, tmp_path, name):
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    step = dict(corpus_pipeline.STAGES)[name]
    last = name == corpus_pipeline.STAGES[-1][0]
    made = step(spark, odd, str(tmp_path))
    assert made.count() > 0 and (last or made.columns == odd.columns)
    if not last:
        assert {c: made.select(c).distinct().collect()[0][0] for c in CLASHES} == {c: f"own {c}" for c in CLASHES}
    assert step(spark, empty, str(tmp_path)).count() == 0
    assert words(None) == []

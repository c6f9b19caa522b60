"""Chat format round trip, page extraction, toxicity and language model on small made inputs; registered queries."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartloom.llm import chat, extract, gru, toxicity
from cartloom.llm.queries import ORACLES, QUERIES
from tests.llm.fixtures import prose
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_queries_match_sql(spark, name):
    assert compare(spark, connect(SF), name, QUERIES[name], ORACLES[name], SF) in (None, "EMPTY")


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_queries_answer_every_row(spark, name):
    table = "pages" if name == "op5_extract" else "documents"
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_native_queries_run_no_python(spark):
    for name in ("op1_mix", "op6_chat"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


AWKWARD = ["<|im_end|>", "<\\|", "<\\\\|im_start|>", "a\nb", "", None, "<", "<|", "|>", "plain <|im_start|>assistant\nok", "\\n"]


def test_chat_round_trip(spark):
    rows = [(1, k, r, t) for k, (r, t) in enumerate((r, t) for t in AWKWARD for r in ("user", "assistant"))]
    rows += [(2, 0, "user", "only asks"), (3, None, None, None), (None, 1, "assistant", "x"), (4, 1, "we<|ird\\n\nrole\\", "t"), (4, 1, "we<|ird\\n\nrole\\", "t")]
    rows += [(5, 1, "a\r\\b", "t"), (5, 2, "\r\\\n\\n\\\\", "u"), (5, 3, "assistant", "v")]
    chats = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("example", F.lit("clash"))
    out = chat.format_chats(chats).withColumn("turns", chat.read_turns(F.col("text"))).collect()
    for conv in (1, 2, 3, None, 4, 5):
        want = [(r or "", t or "") for c, _, r, t in rows if c == conv]
        mine = [r for r in out if r["conv_id"] == conv]
        last = [r for r in mine if r["is_last"]]
        assert len(last) == 1 and [tuple(t) for t in last[0]["turns"]] == want
        replies = [t for r, t in want if r == "assistant"]
        trained = sorted((r for r in mine if r["trainable"]), key=lambda r: r["example"])
        escaped = [r["text"][r["loss_start"] - 1 : r["loss_start"] - 1 + r["loss_chars"]] for r in trained]
        back = spark.createDataFrame([(i, e) for i, e in enumerate(escaped)] or [(0, "")], "i int, e string").select("i", chat.unescape(F.col("e")).alias("t")).orderBy("i").collect()
        assert [r["t"] for r in back][: len(replies)] == replies
        assert all(len(r["turns"]) == r["n_turns"] for r in mine)


@pytest.fixture(scope="module")
def trees():
    rng = np.random.default_rng(1)
    pages = []
    for k in range(40):
        body = "".join(f"<p>{prose(int(rng.integers(15, 50)), 100 * k + j)}.</p>" for j in range(6))
        pages.append((k, f"<html><body><nav><ul><li><a href='/'>{prose(1, k)}</a></li></ul></nav><article><h1>{prose(4, k)}</h1>{body}</article><footer>&copy; {prose(3, k)}</footer></body></html>"))
    return extract.train(pages)


def read(spark, trees, html):
    rows = spark.createDataFrame([(1, html, "old")], "page_id long, html string, text string")
    return extract.extract_text(rows, trees).first()["text"]


def test_extraction(spark, trees):
    main = [prose(40, k) + ", and so on." for k in range(5)]
    paragraphs = "".join(f"<p>{m}</p>" for m in main)
    page = (
        "<!DOCTYPE html><html><head><title>T</title><script>var t='</p>';</script></head><body><div class='menu'><a href='/a'>a</a> <a href='/b'>b</a></div>"
        f"<div class='cookie-notice'>we use cookies</div><div class='post'><h1>Caf&eacute; &amp; bar</h1>{paragraphs}</div>"
        "<div class='comments'><div class='comment'><b>bob</b><p>nice one</p></div></div><form><label>mail</label><input></form><footer>legal</footer>"
    )
    assert read(spark, trees, page).split("\n") == ["Café & bar", *main]


def test_extraction_of_broken_and_empty_pages(spark, trees):
    assert read(spark, trees, None) == "" and read(spark, trees, "") == ""
    assert isinstance(read(spark, trees, "<div><p>a<b>c" + "<div>" * 3000 + "x"), str)
    assert isinstance(read(spark, trees, "<![if !IE]><p>text</p>"), str)


def test_reading_goes_on_behind_what_is_broken():
    def shown(html):
        tree = extract.Tree(html)
        return "|".join(extract.blocks_of(tree, np.ones(len(tree.nodes), bool)))

    broken = "<p>one</p>\n<p>two</p>\n <![foo[ bar <p>three</p>"
    assert shown(broken).startswith("one|two") and shown(broken).endswith("three")
    assert shown("<p>a</p><noscript><p>b</p><p>c</p>") == "a|b|c"
    assert shown("<p>a</p><noscript>x</noscript><svg>y</svg><p>c</p>") == "a|c"


def test_shares_on_unseen_layouts(trees):
    """Pages of unseen texts in known layouts: main words kept, other words dropped."""
    import random

    rng = random.Random(77)
    spare = [prose(30, 9000 + k) for k in range(40)]
    kept_main = main_words = kept_other = other_words = 0
    for k in range(120):
        main = [prose(rng.randint(2, 8), 7000 + k), *[prose(rng.randint(10, 60), 8000 + 50 * k + j) + "." for j in range(rng.randint(2, 8))]]
        tree = extract.MarkedTree(extract.Layout(rng, main, spare).page())
        truth = " ".join(extract.blocks_of(tree, tree.labels() > 0)).split()
        whole = " ".join(extract.blocks_of(tree, np.ones(len(tree.nodes), bool))).split()
        got = " ".join(extract.blocks_of(tree, extract.decode(tree, trees.log_odds(extract.features(tree))))).split()
        hit = len(set(truth) & set(got)) if truth else 0
        kept_main, main_words = kept_main + hit, main_words + len(set(truth))
        outside = set(whole) - set(truth)
        kept_other, other_words = kept_other + len(outside & set(got)), other_words + len(outside)
    assert kept_main / main_words > 0.97 and kept_other / other_words < 0.06, (kept_main / main_words, kept_other / other_words)


def test_decoding_keeps_parents_of_kept_nodes():
    tree = extract.Tree("<div><ul><li>a</li><li>b</li></ul></div><p>c</p>")
    rng = np.random.default_rng(2)
    for _ in range(200):
        kept = extract.decode(tree, rng.normal(0, 3, len(tree.nodes)))
        assert all(kept[n.parent.index] for n in tree.nodes if n.parent and kept[n.index])


def test_toxicity_on_held_out_rows(spark):
    rng = np.random.default_rng(3)
    rows, labels = [(-1, None, "x"), (-2, "", "x"), (None, "some text", "x")], []
    for i in range(600):
        words = prose(40, i).split()
        toxic = i % 4 == 0
        if toxic:
            for j in range(3):
                words[int(rng.integers(0, 40))] = ["zorgel", "vlukin", "zorgelet"][j]
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic), 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    model = toxicity.train(docs, spark.createDataFrame(labels + labels[:5] + [(None, 1, 1), (7, None, 1)], "doc_id long, toxic int, quality int"))
    scored = toxicity.score_toxicity(docs, model).withColumn("held", toxicity.id_remainder(F.col("doc_id"), 3) == 1).collect()
    assert len(scored) == len(rows) and all(0 <= r["score"] <= 1 for r in scored)
    held = [r for r in scored if r["held"] and r["doc_id"] is not None and r["doc_id"] >= 0]
    right = sum((r["score"] >= 0.7) == (r["doc_id"] % 4 == 0) for r in held)
    assert right / len(held) > 0.95
    assert all(r["score"] < 0.7 for r in scored if not r["text"])


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score_toxicity(docs, model).first()["score"] < 0.7


def test_network_gradients():
    """Backpropagation against differences of the loss."""
    rng = np.random.default_rng(4)
    p = gru.Params.of(rng.normal(0, 0.3, gru.Params.start(np.ones(gru.SYMBOLS)).flat().size).astype(np.float32))
    symbols = np.concatenate([rng.integers(1, 200, 11), [0], rng.integers(1, 200, 3), [0]]).astype(np.int16)
    at = np.array([0, 12, 16])
    caught = []
    step, gru.Adam.step = gru.Adam.step, lambda self, params, grads: caught.append(grads)
    try:
        gru.learn(p, symbols, at, 0.1)
    finally:
        gru.Adam.step = step
    flat, grad = p.flat().astype(np.float64), np.concatenate([g.ravel() for g in caught[0]])
    scale = None
    for k in np.argsort(-np.abs(grad))[[0, 3, 10, 40, 90]]:
        up, down = flat.copy(), flat.copy()
        up[k] += 1e-2
        down[k] -= 1e-2
        slope = -(gru.log_probs(gru.Params.of(up), symbols, at).sum() - gru.log_probs(gru.Params.of(down), symbols, at).sum()) / 2e-2
        ratio = slope / grad[k]
        scale = scale or ratio
        assert ratio == pytest.approx(scale, rel=0.03)


def test_network_learns_a_pattern():
    symbols = np.tile(np.array([5, 9, 13, 5, 9, 13, 0], np.int16), 400)
    at = np.arange(0, len(symbols) + 1, 7)
    p = gru.Params.start(np.bincount(symbols, minlength=gru.SYMBOLS).astype(float))
    before = gru.log_probs(p, symbols, at).mean()
    for _ in range(30):
        gru.learn(p, symbols, at, 0.02, streams=16)
    assert gru.log_probs(p, symbols, at).mean() > before / 3
    total = np.exp(gru.log_probs(p, np.arange(gru.SYMBOLS, dtype=np.int16).repeat(2)[1::2], np.arange(gru.SYMBOLS + 1))).size
    assert total == gru.SYMBOLS


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.dtypes == docs.dtypes, name
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        counts.append(docs.count())
    assert counts[0] > counts[2] >= counts[4] and counts[3] == counts[2]
    again = sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "text").collect()))
    assert again == sorted(map(tuple, docs.select("doc_id", "text").collect()))

"""The stages on planted documents, each decision against what was planted; queries against their SQL."""

import random
import re

import corpus_pipeline as P
import pytest
from matchmill.llm import bpe, quality
from matchmill.llm.queries import QUERIES
from tests.conftest import SF_DIR
from tests.llm.helpers import documents, empty, odd
from tests.llm.test_line_dedup import plain as plain_lines
from tests.llm.test_quality import walk
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_equals_sql(spark, con, name):
    assert not compare(QUERIES[name].run(spark, SF_DIR), con, QUERIES[name].sql)


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Good and poor documents, a license line in many, near copies and a benchmark passage; extra columns."""
    draw = random.Random(7)
    word = lambda: "".join(draw.choice("abcdefghijkl") for _ in range(draw.randrange(2, 9)))
    line = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    text = lambda: "\n".join(line(12) for _ in range(10))
    passage, base = line(30), text()
    rows = {i: text() for i in range(60)}
    rows |= {100 + i: " ".join(word().upper() + "!!" for _ in range(120)) for i in range(40)}
    rows |= {200 + i: text() + "\nAll of this is licensed." for i in range(15)}
    rows |= {300 + i: base.replace(".", f" {i}.", 1) for i in range(3)}
    rows |= {400: text() + "\n" + passage + "\n" + text(), 401: passage, 500: None, 501: ""}
    labels = [(i, int(i < 100), 0) for i in rows if i < 200]
    folder = str(tmp_path_factory.mktemp("corpus"))
    documents(spark, list(rows.items())).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([("i1", passage)], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, passage


def test_stages(spark, corpus):
    folder, rows, passage = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in P.STAGES:
        docs = stage(spark, docs, folder)
        path = f"{folder}/{name.replace(' ', '_')}"
        docs.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        kept.append({r.doc_id: r for r in docs.collect()})
        assert docs.columns[: len(columns)] == columns
    good, lines, single, clean, encoded = kept
    assert not set(good) & set(range(100, 140)) and set(good) >= {*range(60), *range(200, 215), 300, 301, 302, 400}
    assert sum("licensed" in (r["text"] or "") for r in lines.values()) == 1 and "licensed" in lines[200]["text"]
    assert {300} == set(single) & {300, 301, 302}
    assert passage[:-1] not in clean[400]["text"] and 401 not in clean and set(range(60)) <= set(clean)
    for i in range(60):
        assert encoded[i]["text"] == rows[i] and encoded[i].n_chars == 7 or encoded[i].n_chars == len(rows[i])
    assert all(r.n_tokens == len(r.token_ids) for r in encoded.values())


def test_run_gives_the_last_stage(spark, corpus):
    folder, _, _ = corpus
    ids = sorted(r.doc_id for r in P.run(spark, folder).collect())
    assert set(range(60)) <= set(ids) and not set(ids) & {*range(100, 140), 301, 302, 401}


def test_encoding_takes_one_python_function_at_a_time(spark, corpus):
    """Two in one task are two Python workers, which both stay for the stages after."""
    folder, rows, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = P.encoding_stage(spark, docs, folder)
    assert out._jdf.queryExecution().sparkPlan().toString().count("EvalPython") == 1
    assert out.columns == [*docs.columns, "token_ids", "n_tokens"]
    assert {r.doc_id: r["text"] for r in out.collect()} == {i: t or "" for i, t in rows.items()}


def plain_run(rows, benchmark, forest):
    """{doc_id: (text, ids)} by all pairs, dictionaries and trees walked one by one."""
    import public_tokenizers

    good = {i: t for i, t in rows.items() if walk(forest, quality.statistics([t])[0]) >= 0.3}
    lines = plain_lines(list(good.items()), 10, 1, True)
    texts = {}
    for i, text in good.items():
        kept = lines[i, text]
        # A text without a line left goes; one that had none to lose stays.
        if kept or not (text or "").strip():
            texts[i] = kept if text is not None else None
    shingles = {}
    for i, text in texts.items():
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
        shingles[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else {()}
    above = {i: i for i in texts}

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    for a in texts:
        for b in texts:
            if a < b and len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]):
                low, high = sorted((root(a), root(b)))
                above[high] = low
    single = {i: t for i, t in texts.items() if root(i) == i}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    cut = lambda t: [(m.group(), m.span()) for m in word.finditer("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))]
    windows = set()
    for item in benchmark:
        words = [w for w, _ in cut(item)]
        size = min(10, len(words))
        windows |= {tuple(words[k : k + size]) for k in range(len(words) - size + 1) if size}
    out = {}
    encoding = bpe.Coder(open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read(), public_tokenizers.PATTERN)
    for i, text in single.items():
        found, hit = cut(text), set()
        for size in {len(w) for w in windows}:
            for k in range(len(found) - size + 1):
                if tuple(w for w, _ in found[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
        if 2 * len(hit) > len(found):
            continue
        for k in sorted((k for k in hit if k - 1 not in hit), reverse=True):
            last = next(j for j in range(k, len(found)) if j + 1 not in hit)
            text = text[: found[k][1][0]] + text[found[last][1][1] :]
        out[i] = (text or "", encoding.encode(text or "").tolist())
    return out


def test_all_rows_by_a_plain_version(spark, tmp_path):
    """Every row of run(): near copies at 0.8 and above and below, shared lines, passages over the whole range of coverage."""
    draw = random.Random(21)
    word = lambda: "".join(draw.choice("abcdefghijkl") for _ in range(draw.randrange(2, 9)))
    line = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    text = lambda: "\n".join(line(12) for _ in range(10))
    items = [line(30), line(45), line(6)]
    rows = {i: text() for i in range(50)}
    rows |= {100 + i: " ".join(word().upper() + "!!" for _ in range(120)) for i in range(40)}
    rows |= {200 + i: text() + "\nAll of this is licensed.\n" + line(3) for i in range(12)}
    for i in range(30):
        words = rows[i].split(" ")
        for at in range(3, 3 + 12 * (i % 5), 12):
            words[at % len(words)] = word()
        rows[300 + i] = " ".join(words)
    for i in range(12):
        rows[400 + i] = line(5 * i + 1) + "\n" + " ".join([items[i % 3], *[items[1]] * (i % 2)]) + "\n" + line(9)
    rows |= {500: None, 501: "", 502: rows[3], 503: "All of this is licensed."}
    labels = [(i, int(i < 100), 0) for i in rows if i < 140]
    folder = str(tmp_path)
    spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(f"i{k}", t) for k, t in enumerate(items)], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    forest = quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    want = plain_run(rows, items, forest)
    got = {r.doc_id: (r["text"], list(r.token_ids)) for r in P.run(spark, folder).collect()}
    assert len(want) > 60 and got == want


def test_odd_rows_in_every_stage(spark, corpus):
    folder, _, _ = corpus
    for docs in (odd(spark), empty(spark)):
        for _, stage in P.STAGES:
            out = stage(spark, docs, folder)
            assert out.columns[: len(docs.columns)] == docs.columns
            assert out.count() <= docs.count()

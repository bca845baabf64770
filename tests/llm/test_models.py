"""Toxicity, URL models, sharding and the pipeline."""

import collections
import math
import time
import zlib

import numpy as np
import pytest
from conftest import CLASHING, ODD
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
import corpus_pipeline
from tillstar.llm import sharding, toxicity, urls
from tillstar.llm.common import alnum_words


def tiny():
    model = toxicity.new_model(1)
    parts = toxicity.features([b"ab", b"cde", b"f", b"xyz"])
    at = np.full((3, toxicity.WINDOW), 4)
    at[0, :3], at[1, 0], at[2] = [0, 1, 2], 3, np.arange(toxicity.WINDOW) % 4
    return model, parts, at, np.array([1, 0, 1], np.float32)


def test_gradients_match_differences():
    model, parts, at, label = tiny()

    def loss():
        p = toxicity.window_scores(model, toxicity.vectors(model, parts), at).astype(float)
        return -(label * np.log(p) + (1 - label) * np.log(1 - p)).mean()

    for name, g in toxicity.gradients(model, parts, at, label).items():
        place = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        old = model[name][place]
        model[name][place] = old + 1e-2
        up = loss()
        model[name][place] = old - 1e-2
        down = loss()
        model[name][place] = old
        assert math.isclose(g[place], (up - down) / 2e-2, rel_tol=0.1, abs_tol=1e-4), name


def plain_score(model, text):
    """The network's equations word by word, in doubles: the highest score of the windows."""
    size = toxicity.HIDDEN
    m = {name: value.astype(np.float64) for name, value in model.items()}

    def logistic(v):
        return 1 / (1 + np.exp(-v))

    def vector(word):
        spaced = b" " + word + b" "
        triples = [int.from_bytes(spaced[i : i + 3], "big") for i in range(len(word))]
        buckets = [(t * 0x9E3779B1 >> 7) % toxicity.BUCKETS for t in triples]
        mean = sum(m["letters"][b] for b in buckets) / len(buckets)
        return m["words"][zlib.crc32(word) % toxicity.BUCKETS] + mean

    def states(words, way):
        h, made = np.zeros(size), []
        for x in words if way == "f" else words[::-1]:
            into, back = x @ m[f"in_{way}"] + m[f"bias_{way}"], h @ m[f"own_{way}"]
            update, reset = logistic(into[:size] + back[:size]), logistic((into + back)[size : 2 * size])
            fresh = np.tanh(into[2 * size :] + reset * back[2 * size :])
            h = (1 - update) * fresh + update * h
            made.append(h)
        return made if way == "f" else made[::-1]

    def window(words):
        both = [np.concatenate(pair) for pair in zip(states(words, "f"), states(words, "b"), strict=True)]
        asked = np.exp([np.tanh(s @ m["attend"]) @ m["ask"] for s in both])
        mean = sum(a * s for a, s in zip(asked, both, strict=True)) / asked.sum()
        return float(logistic(mean @ m["out"] + m["bias"][0]))

    words = [vector(w) for w in alnum_words(text)]
    found, at = [], 0
    while words:
        found.append(window(words[at : at + toxicity.WINDOW]))
        if at + toxicity.WINDOW >= len(words):
            break
        at += toxicity.STRIDE
    return max(found, default=0.0)


def test_scores_match_the_plain_network(spark, docs):
    draw = np.random.default_rng(5)
    model = toxicity.new_model(5)
    for value in model.values():  # far from the start, so that gates and attention tell words apart
        value += draw.standard_normal(value.shape).astype(np.float32) * 0.4
    names = ["ab", "É", "x", "longer9", "日本", "the", "Fool", "vile"] + [f"w{i}" for i in range(40)]
    pairs = [(i, " ".join(draw.choice(names, n))) for i, n in enumerate((1, 2, 16, 31, 32, 33, 47, 48, 49, 64, 65, 300))]
    made = toxicity.toxicity(docs(pairs + ODD), model).collect()
    assert len(made) == len(pairs + ODD)
    found = {round(r.score, 3) for r in made}
    for r in made:
        assert math.isclose(r.score, plain_score(model, r.text), abs_tol=1e-4), r.text
    assert len(found) > 10


def test_windows_reach_every_word():
    for n in range(1, 200):
        begin = list(toxicity.starts(n))
        assert begin[0] == 0 and begin[-1] + toxicity.WINDOW >= n
        assert all(b - a == toxicity.STRIDE for a, b in zip(begin, begin[1:]))
        assert len(begin) == 1 or begin[-2] + toxicity.WINDOW < n


def test_windows_hold_short_passages_whole():
    for n in (17, 40, 100, 321):
        begin = toxicity.starts(n)
        for at in range(n - 16):
            assert any(b <= at and at + 17 <= b + toxicity.WINDOW for b in begin), (n, at)


def labelled(spark, docs):
    """Texts of common words, some with one of two bad words somewhere."""
    draw = np.random.default_rng(0)
    common = [f"{a}{b}" for a in ("ka", "lo", "mi", "tu") for b in ("ran", "sel", "dor", "vim")]
    pairs, labels = [], []
    for i in range(400):
        words = [common[k] for k in draw.integers(0, len(common), draw.integers(5, 120))]
        toxic = i % 4 == 0
        if toxic:
            words[draw.integers(0, len(words))] = ("vile", "fool")[i % 8 // 4]
        pairs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    kind = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("toxic", T.IntegerType())])
    return docs(pairs + ODD), spark.createDataFrame([*labels, (None, 1), (3, None)], kind), dict(labels)


def test_held_out_accuracy(spark, docs):
    table, labels, known = labelled(spark, docs)
    model = toxicity.fit(table, labels)
    made = toxicity.toxicity(table, model)
    assert made.columns.count("score") == 1 and "kept" in made.columns
    rows = [r for r in made.collect() if r.text and alnum_words(r.text)]
    out = [r for r in rows if r.doc_id and r.doc_id > 20 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = sum(r.predicted == known[r.doc_id] for r in out)
    assert right >= 0.95 * len(out)
    assert all((r.predicted == 1) == (r.score >= 0.5) for r in rows)


def test_score_ignores_all_but_the_text(spark, docs):
    table, labels, _ = labelled(spark, docs)
    model = toxicity.fit(table, labels)
    rows = toxicity.toxicity(docs([(5, "a vile one"), (99, "a vile one"), (None, "a vile one")]), model)
    assert len({r.score for r in rows.collect()}) == 1


def test_no_labels_and_no_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(docs(ODD), none) is None
    rows = toxicity.toxicity(docs(ODD), None).collect()
    assert len(rows) == len(ODD) and {(r.score, r.predicted) for r in rows} == {(0.0, 0)}
    assert toxicity.toxicity(docs([]), None).count() == 0


def sampled(monkeypatch, *args, **more):
    """The (label, windows) that fit() hands to train()."""
    seen = []
    monkeypatch.setattr(toxicity, "train", seen.extend)
    toxicity.fit(*args, **more)
    return seen


def test_sampled_texts_keep_all_windows(spark, docs, monkeypatch):
    learned = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    sizes = dict(zip(learned, [1500, 4, 3000, 50, 20, 700, 9, 2000]))
    table = docs([(i, " ".join(f"w{i}x{k}" for k in range(n))) for i, n in sizes.items()])
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(sizes)], "doc_id long, toxic int")
    want = {f"w{i}x0".encode(): len(toxicity.starts(n)) for i, n in sizes.items()}

    def got(**more):
        return {w[0].split()[0]: len(w) for _, w in sampled(monkeypatch, table, labels, **more)}

    assert got() == want
    some = got(windows=150)  # 50 for toxic texts and 100 for clean ones: whole texts alone
    assert some and some.items() < want.items() and sum(some.values()) <= 150


def test_sample_is_of_texts_that_are_there_once(spark, docs, monkeypatch):
    learned = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 5]
    labels = spark.createDataFrame([(i, i % 2) for i in learned], "doc_id long, toxic int")
    pairs = [(i, f"text w{i}") for i in learned[::100]]
    table = docs(pairs + pairs[:1] * 300 + [(pairs[1][0], "another one"), (pairs[2][0], None)])
    found = sampled(monkeypatch, table, labels, positive=40, negative=40)
    want = [(i % 2, [t.encode()]) for i, t in [*pairs, (pairs[1][0], "another one")]]
    assert sorted(found) == sorted(want)
    assert len(sampled(monkeypatch, table, labels, positive=3, negative=2)) == 5


def test_early_windows_are_of_all_texts():
    assert toxicity.turns(np.array([3, 3, 1, 3, 1, 2])).tolist() == [0, 1, 0, 2, 1, 0]
    assert toxicity.turns(np.zeros(0, int)).tolist() == []


def test_held_out_is_the_checksum():
    assert toxicity.parting(np.array([0.0, 1, 2, 9, 10]), np.array([0, 0, 0, 1, 1])) == 5.5
    assert toxicity.parting(np.array([1.0, 2]), np.array([1, 1])) == 0.0


def test_held_out_column(spark, sf_dir):
    rows = entry.queries()["op4_toxicity"](spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


# sharding


@pytest.mark.parametrize("shards, bucket", [(1, 1000), (7, 500), (40, 10**9)])
def test_shards_are_even_and_whole(docs, shards, bucket):
    pairs = ODD + [(k % 3, "same") for k in range(150)] + [(None, None)] * 150
    table = docs(pairs).withColumn("size", F.octet_length("text"))
    made = sharding.shuffled_shards(table, shards, bucket_bytes=bucket)
    assert made.columns == [c for c in table.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    rows = made.collect()
    assert collections.Counter((r.doc_id, r.text) for r in rows) == collections.Counter(pairs)
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[k]) for k in range(shards)]
    assert max(counts) - min(counts) <= 1


def test_plan_is_native_and_shuffles_once(docs):
    table = docs(ODD).withColumn("size", F.lit(1))
    plan = sharding.shuffled_shards(table, 4)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_order_is_uniform_over_places(spark):
    table = spark.range(3000).withColumn("size", F.lit(10))
    rows = sharding.shuffled_shards(table, 1, bucket_bytes=3000).collect()
    rank = np.array([r.id for r in sorted(rows, key=lambda r: r.slot)])
    assert abs(np.corrcoef(rank, np.arange(3000))[0, 1]) < 0.08
    other = sharding.shuffled_shards(table, 1, seed=99, bucket_bytes=3000).collect()
    assert [r.id for r in sorted(other, key=lambda r: r.slot)] != rank.tolist()


def test_written_shards_keep_their_order(docs, tmp_path, spark):
    table = docs([(k, f"text {k}") for k in range(100)]).withColumn("size", F.lit(16))
    sharding.write_shards(sharding.shuffled_shards(table, 4), f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out/shard=2").collect()
    assert [r.slot for r in back] == sorted(r.slot for r in back) and len(back) == 25


def test_empty_shards(docs):
    assert sharding.shuffled_shards(docs([]).withColumn("size", F.lit(1)), 3).count() == 0
    with pytest.raises(ValueError):
        sharding.shuffled_shards(docs([]), 0, "text")


# URLs


def split(url):
    """Host and path by hand."""
    head, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host):].split("#")[0].split("?")[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def rule_of(host, path):
    best = None
    for verdict, name, start in urls.RULES:
        if (host == name or host.endswith("." + name)) and path.startswith(start):
            if best is None or len(name + start) > len(best[0]):
                best = (name + start, verdict)
    return best or (None, None)


def brute_scores(texts, order):
    """Scores with all URLs, by direct counting."""
    grams = {k: collections.Counter() for k in "ar"}
    kinds = {"allow": "a", "block": "r"}
    for url in texts:
        verdict = rule_of(*split(url))[1]
        padded = urls.START * order + url + urls.END
        for i in range(order, len(padded)):
            for width in range(order + 1):
                if verdict:
                    grams[kinds[verdict]][padded[i - width : i + 1]] += 1

    def chance(kind, gram):
        low = urls.UNSEEN if len(gram) == 1 else chance(kind, gram[1:])
        after = [n for g, n in grams[kind].items() if len(g) == len(gram) and g[:-1] == gram[:-1]]
        if not after:
            return low
        return (grams[kind][gram] + len(after) * low) / (sum(after) + len(after))

    out = {}
    for url in texts:
        padded = urls.START * order + url + urls.END
        parts = [padded[i - order : i + 1] for i in range(order, len(padded))]
        out[url] = sum(math.log(chance("a", g)) - math.log(chance("r", g)) for g in parts) / len(parts)
    return out


def pages(spark, values):
    kind = T.StructType(
        [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType())]
        + [T.StructField(c, T.StringType()) for c in ("host", "rule", "score", "id", "kind")]
    )
    return spark.createDataFrame([(i, u, *"vwxyz") for i, u in enumerate(values)], kind)


URLS = [
    "https://a.com/x", "http://B.COM/y?q#f", "https://www.example.com/en/1", "https://example.com/en/2",
    "https://sub.example.com/en/3", "https://notexample.com/en/4", "https://x.net/es/", "https://net/fr/q",
    "https://x.net/de/5", "https://y.org/", "https://y.org", "noscheme", "", None, None, "://", "a://b://c/d",
    "https://com", "https://com/", "https://É.COM/É", "https://x.net/de/5", "https://z.net?x=/fr/",
] * 2


def test_hosts_paths_and_rules(spark):
    rows = urls.judged_urls(pages(spark, URLS)).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        host, path = split(r.url)
        rule, verdict = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule), r.url
        assert r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)
        assert (r.score is None) == (rule is not None)
        assert r.url is not None or r.score == 0


def test_scores_match_direct_counting(spark):
    texts = sorted({u for u in URLS if u is not None})
    scored, _ = urls.url_scores(pages(spark, URLS), order=2)
    want = brute_scores(texts, 2)
    rows = scored.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert math.isclose(r.score, want[r.url], abs_tol=1e-5)


def test_models_tell_kinds_apart(spark):
    """URLs that no rule decides follow those that look like them."""
    values = [f"https://good{i}.com/page/{i}" for i in range(60)]
    values += [f"https://bad{i}.net/es/{i}" for i in range(60)]
    values += [f"https://good{i}.org/page/{i}" for i in range(100, 120)]
    values += [f"https://bad{i}.org/es/{i}" for i in range(100, 120)]
    rows = [r for r in urls.judged_urls(pages(spark, values)).collect() if r.rule is None]
    right = sum((r.verdict == "allow") == ("good" in r.url) for r in rows)
    assert right >= 0.9 * len(rows)


@pytest.mark.parametrize("order", [1, 4, 70])
def test_grams_are_those_of_the_whole_url(spark, order):
    texts = ["", "x", "é🎉\n" * 50, *["ab" * n + "c" * (n % 2) for n in (29, 30, 31, 32, 61, 62, 63, 64)]]
    seen = spark.createDataFrame([(t,) for t in texts], "url string")
    rows = collections.Counter((r.url, r.gram) for r in urls._grams(seen, order).collect())
    want = collections.Counter()
    for t in texts:
        padded = urls.START * order + t + urls.END
        want.update((t, padded[i : i + order + 1]) for i in range(len(t) + 1))
    assert rows == want


def test_long_urls_take_time_in_proportion(spark):
    values = [*URLS, "https://x.org/" + "a.b/" * 250_000, "x" * 1_000_000, "://" * 300_000, "é?#" * 200_000]
    began = time.time()
    rows = urls.judged_urls(pages(spark, values)).collect()
    assert len(rows) == len(values) and time.time() - began < 60


def test_no_pages(spark):
    assert urls.judged_urls(pages(spark, [])).count() == 0
    only = urls.judged_urls(pages(spark, ["https://x.org/a", None])).collect()
    assert [r.verdict for r in only] == ["allow", "allow"]  # no model: a score of 0 and no threshold


# pipeline


def test_stages(spark, sf_dir):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "substring_dedup", "decontamination", "byte_bpe"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, sf_dir)
        assert made.columns == docs.columns, name


def test_pipeline_works_on_odd_rows(spark, docs, tmp_path):
    folder = str(tmp_path)
    table = docs(ODD).drop(*CLASHING).withColumns(
        {"lang": F.lit(None).cast("string"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")}
    )
    table.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "nothing of this")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} == {i for i, _ in ODD}


def test_pipeline_result(spark, sf_dir):
    rows = entry.queries()["pipeline"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert 0.6 * docs < len(rows) < docs
    assert len({r.doc_id for r in rows}) == len(rows)
    assert all(r.n_tokens == len(r.ids) for r in rows)

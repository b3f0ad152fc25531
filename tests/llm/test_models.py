import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from helpers import AWKWARD, EXTRA, PROSE, documents
from pyspark.sql import functions as F

from blendwise.llm import llr_rules, pii, pseudo_likelihood as lm, quality_cnn as cnn
from blendwise.llm.common import BATCH_BYTES, table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labelled():
    rows = duckdb.sql(f"SELECT doc_id, text, quality FROM '{SF}/documents.parquet' JOIN '{SF}/labels.parquet' USING (doc_id)").fetchall()
    return [(t.encode(), q, zlib.crc32(str(d).encode()) % 5 == 0) for d, t, q in rows]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(5, 1), (4, 0), (4, 1), (6, 1), (None, 1), (7, None), (7, 0), (10, 0)], "doc_id long, quality int")


def test_network_learns_quality(labelled):
    model = cnn.ByteCNN()
    model.fit([(t, q) for t, q, held in labelled if not held], epochs=14)
    scores = [(model.score(t.decode()), q) for t, q, held in labelled if held]
    good, bad = [s for s, q in scores if q], [s for s, q in scores if not q]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.9 and np.mean([s >= 0.3 for s in good]) > 0.9


def test_network_gradient():
    model = cnn.ByteCNN(seed=1)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    raw, label = ("Some bytes ### with é " * 30).encode(), 1.0

    def loss():
        best = model.pooled(raw)[0].astype(np.float64)
        return -np.log(model.head(model.document(best)[0])[1][0])

    grads = {k: np.zeros_like(v) for k, v in model.p.items()}
    model.gradient(raw, label, grads)
    rng = np.random.default_rng(0)
    for name in ("conv", "emb", "h", "o", "conv_b"):
        flat, g = model.p[name].reshape(-1), grads[name].reshape(-1)
        for i in rng.choice(np.flatnonzero(np.abs(g) > 1e-3), 3):
            old = flat[i]
            flat[i] = old + 1e-3
            up = loss()
            flat[i] = old - 1e-3
            assert abs((up - loss()) / 2e-3 - g[i]) < 0.05 * abs(g[i]) + 2e-3, name
            flat[i] = old


def test_network_sees_the_whole_document():
    model = cnn.ByteCNN()
    raw = b"plain words here " * 20_000
    best, _ = model.pooled(raw)
    assert len(best) == -(-len(raw) // cnn.HALF)
    at = len(raw) - 3
    changed = model.pooled(raw[:at] + b"\xff\xfe\xfd")[0]
    assert (changed[-1] != best[-1]).any() and (changed[:-2] == best[:-2]).all()
    one = model.pooled(raw[:5000])[0]  # blocks do not change a value
    assert np.allclose(one[:30], best[:30])


def test_classifier_on_awkward_rows(spark, labels):
    docs = documents(spark, AWKWARD, **EXTRA)
    sample = cnn.labelled_sample(docs, labels, size=50)
    assert len(sample) <= 7 and all(isinstance(t, bytes) for t, _ in sample)
    model = cnn.fit_quality(docs, labels)
    rows = docs.select("doc_id", "text", cnn.score_column(model, F.col("text")).alias("p"), cnn.held_out().alias("h")).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.p <= 1 for r in rows)
    assert all(r.h == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0) for r in rows)
    assert len({r.p for r in rows if not r.text}) == 1
    empty = cnn.fit_quality(docs.limit(0), labels)
    assert empty.score("x") == 0.5


def brute_rules(text):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", text or "") if w]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def grams(text):
    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    words = [w for w in re.split(r"[\x20\x09-\x0d]+", text or "") if w]
    h = [signed(xxhash.xxh64_intdigest(w.lower().encode(), 42)) for w in words]
    one = [x % llr_rules.BUCKETS for x in h]

    def pair(a, b):  # Spark hashes a column with the hash of the one before as the seed
        first = xxhash.xxh64_intdigest(a.to_bytes(8, "little", signed=True), 42)
        return signed(xxhash.xxh64_intdigest(b.to_bytes(8, "little", signed=True), first))

    return one + [pair(a, b) % llr_rules.BUCKETS for a, b in zip(h, h[1:])]


def test_rules_match_brute_force(spark, labels):
    rows = AWKWARD + [(20 + i, t) for i, t in enumerate(
        ["a b c d e f a b c d e f g h i j k l m n o p q r s t u v w x", "x x x x x x x x x x x x", "one two three\n\none two three\n one two three ",
         "\x0b\x0ca  b\tc # * $ % & | < >\r\nd e f g h i j", "ab cd ef gh ij kl mn op qr st uv wx ab cd ef gh ij zz ab cd ef gh ij"])]
    docs = documents(spark, rows, **EXTRA)
    ratios = llr_rules.fit_ratios(docs, labels)
    raw, good = np.zeros(llr_rules.BUCKETS), np.zeros(llr_rules.BUCKETS)
    trusted = {5, 6}  # quality 1 and no 0
    for i, t in rows:
        for g in grams(t):
            raw[g] += 1
            good[g] += i in trusted
    want = np.log((good + 1) / (good.sum() + llr_rules.BUCKETS)) - np.log((raw + 1) / (raw.sum() + llr_rules.BUCKETS))
    assert (ratios == np.rint(want * 1e6).astype(int)).all()
    got = sorted(map(tuple, llr_rules.quality_rules(docs, ratios, -0.5).collect()), key=str)
    expect = []
    for i, t in rows:
        base, g = brute_rules(t), grams(t)
        total = int(ratios[g].sum()) if g else 0
        n = max(1, len(g))
        expect.append((i, *base[:5], base[5], total // n, bool(not base[5] and total >= -500_000 * n)))
    assert got == sorted(expect, key=str)
    assert llr_rules.quality_rules(docs.limit(0), ratios).count() == 0
    assert not llr_rules.fit_ratios(docs, labels.limit(0)).any()


def test_trusted_ids_meet_the_texts_in_the_same_way_at_any_size(spark, labels):
    few = llr_rules.bucket_counts(documents(spark, AWKWARD), labels)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan and "SortMergeJoin" not in plan
    grown = [(i, t) for i, t in AWKWARD for _ in range(2)]  # ids and texts that come twice count twice
    twice = {r.bucket: (r.raw, r.good) for r in llr_rules.bucket_counts(documents(spark, grown), labels.union(labels)).collect()}
    assert twice == {r.bucket: (2 * r.raw, 2 * r.good) for r in few.collect()}


def test_context_counts_cross_the_shuffle_packed(spark):
    docs = documents(spark, AWKWARD * 3).repartition(5)
    plan = lm.context_counts(docs, lm.vocabulary(docs))._jdf.queryExecution().executedPlan().toString()
    assert "cells" in plan and "HashAggregate" not in plan


def test_context_counts_are_added_in_small_parts(spark):
    words = [f"w{i}" for i in range(lm.WORDS)]
    counts = lm.context_counts(documents(spark, [(1, " ".join(words)), (2, " ".join(words[::-1]))]), words)
    left = F.floor(F.col("context") / lm.VOCABULARY)
    tasks = counts.select(F.spark_partition_id().alias("task"), left.alias("left")).groupBy("task").agg(F.count_distinct("left").alias("n")).collect()
    assert sum(r["n"] for r in tasks) == lm.WORDS + 1 and max(r["n"] for r in tasks) < 30


def test_a_worker_gets_texts_in_small_batches(spark, tmp_path):
    documents(spark, [(i, "x" * 200_000) for i in range(100)]).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    found = table(spark, str(tmp_path), "documents").mapInArrow(sizes, "n long, size long").collect()
    assert sum(r["n"] for r in found) == 100 and max(r["size"] for r in found) < BATCH_BYTES + 300_000


def test_language_model(spark):
    docs = documents(spark, AWKWARD, **EXTRA)
    words = lm.vocabulary(docs)
    counted = Counter(w for _, t in AWKWARD for w in lm.words_of(t))
    assert words == [w for w, _ in sorted(counted.items(), key=lambda x: (-x[1], x[0]))[:lm.WORDS]]
    tokens, cells = lm.Tokens(words), Counter()
    for _, t in AWKWARD:
        x = tokens.of(t).tolist()
        cells.update((a * lm.VOCABULARY + c, b) for a, b, c in zip(x, x[1:], x[2:]))
    counts = lm.context_counts(docs, words)
    assert {(r.context, r.token): r.n for r in counts.collect()} == cells
    p = lm.train(counts)
    z = lm.normalisers(p)
    text = PROSE + " unseen"
    x, total = tokens.of(text), 0.0
    for a, b, c in zip(x, x[1:], x[2:]):
        logits = np.tanh(p["left"][a] + p["right"][c] + p["hidden"]) @ p["out"] + p["bias"]
        total += logits[b] - np.log(np.exp(logits.astype(np.float64)).sum())
    assert abs(lm.document_score(p, z, x) - total) < 1e-2
    rows = lm.pseudo_likelihood(docs).collect()
    assert len(rows) == len(AWKWARD)
    assert all((r.n_tokens == 0) == (r.mean_log_likelihood is None) and r.log_likelihood <= 0 for r in rows)
    assert lm.pseudo_likelihood(docs.limit(0)).count() == 0


def test_language_model_gradient():
    rng = np.random.default_rng(2)
    p = {k: v.astype(np.float64) for k, v in lm.initial().items()}
    contexts, counts = np.array([3, 700, 65_000]), rng.integers(0, 3, (3, lm.VOCABULARY)).astype(np.float64)

    def loss():
        h = lm.activations(p, contexts // lm.VOCABULARY, contexts % lm.VOCABULARY)
        return -(lm._log_softmax(h @ p["out"] + p["bias"]) * counts).sum() / counts.sum()

    g = lm.gradients(p, contexts, counts)
    for k in p:
        flat, own = p[k].reshape(-1), g[k].reshape(-1)
        i = int(np.abs(own).argmax())
        old = flat[i]
        flat[i] = old + 1e-4
        up = loss()
        flat[i] = old - 1e-4
        assert abs((up - loss()) / 2e-4 - own[i]) < 1e-3 * abs(own[i]) + 1e-6, k
        flat[i] = old


def test_language_model_prefers_its_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    words = lm.vocabulary(docs)
    p = lm.train(lm.context_counts(docs, words))
    z, tokens = lm.normalisers(p), lm.Tokens(words)
    text = docs.where("lang = 'en' and n_chars between 2000 and 4000").orderBy("doc_id").first()["text"]
    ordered = lm.document_score(p, z, tokens.of(text))
    mixed = text.split()
    np.random.default_rng(0).shuffle(mixed)
    uniform = -len(mixed) * np.log(lm.VOCABULARY)
    assert ordered > uniform and ordered > lm.document_score(p, z, tokens.of(" ".join(mixed[:len(mixed)]))) - 0.05 * len(mixed)


def brute_base(t):
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((m.start(), m.end(), "card"))
    out += [(m.start(), m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_base_spans_match_the_patterns():
    rng = np.random.default_rng(4)
    letters = "+0123459..--@@ab ()\n_%é"
    for _ in range(20_000):
        s = "".join(letters[i] for i in rng.integers(0, len(letters), rng.integers(1, 30)))
        if rng.random() < 0.3:
            s = s + "4111111111111111" + s
        assert sorted(pii.base_spans(s)) == brute_base(s), s


@pytest.fixture(scope="module")
def field(spark):
    return pii.fit_field(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), size=400)


def test_field_gradient():
    rng = np.random.default_rng(0)
    crf = pii.SemiMarkovCRF(rng.normal(0, 0.3, (pii.FEATURES, len(pii.KINDS))))
    text = "see 10.0.0.1 or +1 (651) 555-8500 a.b@c.org 12"
    gold = {}
    lattices = []
    for region in pii.regions(text):
        atoms, candidates = pii.segments(text, *region)
        spans = {(s, e): k for s, e, k in pii.base_spans(text)}
        gold = {(i, j): spans[(atoms[i][0], atoms[j - 1][1])] for i, j, _ in candidates if (atoms[i][0], atoms[j - 1][1]) in spans}
        lattices.append((atoms, candidates, gold))
    grad = np.zeros_like(crf.weights)
    for x in lattices:
        crf.gradient(*x, grad)
    value = lambda: sum(crf.gradient(*x, np.zeros_like(grad)) for x in lattices)
    for f, k in [(0, 0), (3, 3), (12, 1), (8, 0), (18, 3)]:
        crf.weights[f, k] += 1e-5
        up = value()
        crf.weights[f, k] -= 2e-5
        assert abs((up - value()) / 2e-5 - grad[f, k]) < 1e-4
        crf.weights[f, k] += 1e-5


def test_decoding_is_the_best_segmentation():
    rng = np.random.default_rng(1)
    text = "1 22 (333) 4-5"
    for _ in range(20):
        crf = pii.SemiMarkovCRF(rng.normal(0, 1, (pii.FEATURES, len(pii.KINDS))))
        atoms, candidates = pii.segments(text, 0, len(text))
        score = {(i, j): crf.weights[f].sum(0).max() for i, j, f in candidates}

        def best(at):
            if at == len(atoms):
                return 0.0
            return max([best(at + 1), *(score[at, j] + best(j) for j in range(at + 1, len(atoms) + 1) if (at, j) in score)])

        where = {(atoms[i][0], atoms[j - 1][1]): s for (i, j), s in score.items()}
        got = sum(where[s, e] for s, e, _ in crf.decode(text, 0, len(text)))
        assert abs(got - best(0)) < 1e-9


def test_field_finds_other_notations_and_leaves_lookalikes(field):
    found = lambda s: [(k, s[a:b]) for a, b, k, base in pii.find(s, field) if not base]
    assert ("phone", "(651) 555-8500") in found("call (651) 555-8500 now")
    for s in ("on 2024-01-05", "v1.2.3 and 3.14", "the 999.1.2.3 host", 'token = "40d78a45c418324758e099eb7cb89bc0f5fa9f62"', "page 12 of 30"):
        assert found(s) == [], s


def test_field_agrees_with_the_patterns_on_unseen_texts(spark, field):
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("text rlike '[0-9@]'").select("text").collect()
    hits = missed = 0
    for (text,) in rows:
        own = {x for region in pii.regions(text) for x in field.decode(text, *region)}
        gold = set(pii.base_spans(text))
        hits, missed = hits + len(gold & own), missed + len(gold - own)
    assert hits > 20 and hits / (hits + missed) > 0.9


def test_personal_data_on_awkward_rows(spark, field):
    docs = documents(spark, AWKWARD + [(30, "mail a.b@c.org, é 10.0.0.1\n+1 (651) 555-8500."), (31, "+" * 3000 + "1.2." * 3000)], **EXTRA)
    out = docs.select("doc_id", "text", pii.spans_column(field, F.col("text")).alias("x"), pii.redacted_column(field, F.col("text")).alias("r"))
    for r in out.collect():
        base = [(x.start, x.end, x.kind) for x in r.x if x.base]
        assert sorted(base) == brute_base(r.text or "")
        if r.doc_id == 30:
            assert r.r == "mail [EMAIL], é [IP]\n[PHONE]."
        if r.text is None:
            assert r.r is None
        elif not r.x:
            assert r.r == r.text
    assert pii.fit_field(docs.limit(0)).weights.shape == (pii.FEATURES, len(pii.KINDS))


def test_long_zeros_are_a_small_number():
    text = "0" * 5000 + ".1.2.3 and 00000000300.1.2.3"
    assert pii.base_spans(text) == [(0, 5006, "ip")]


def test_regions_join_words_over_any_short_white_space():
    assert pii.regions("call 555\t123\n4567 or  1  2") == [(5, 17), (22, 26)]
    assert len(pii.regions("1" + " " * (pii.GAP + 1) + "2")) == 2


def test_many_base_spans_do_not_slow_the_field():
    import time
    field = pii.SemiMarkovCRF()
    seconds = []
    for n in (300, 600):
        text = "ip 10.0.0.1 x " * n
        began = time.perf_counter()
        assert sum(b for *_, b in pii.find(text, field)) == n
        seconds.append(time.perf_counter() - began)
    assert seconds[1] < 3 * seconds[0] + 0.5


def test_a_silent_network_and_rare_labels_do_not_stop_the_fit():
    from blendwise.llm import quality_cnn
    model = quality_cnn.ByteCNN()
    model.p["h"][:] = 0
    model.p["h_b"][:] = 0
    grads = {k: v * 0 for k, v in model.p.items()}
    model.gradient(b"some words", 1, grads)
    rng = __import__("numpy").random.default_rng(0)
    order = quality_cnn._mixed_classes([1] * 60 + [0] * 4, rng)
    assert len(order) == 64 and sum(i >= 60 for i in order) == 32
    assert sorted(quality_cnn._mixed_classes([1] * 5, rng)) == [0, 1, 2, 3, 4]


def test_every_good_label_is_trusted(spark):
    labels = spark.range(20_050).selectExpr("id AS doc_id", "1 AS quality")
    assert llr_rules.trusted_ids(labels).count() == 20_050


@pytest.mark.parametrize("known", [0, 50_000])
def test_words_outside_the_vocabulary_are_predicted_as_themselves(spark, monkeypatch, known):
    """Two words of one class, of which one is nine times as frequent, differ by log 9."""
    monkeypatch.setattr(lm, "KNOWN", known)  # shares from the join alone, or from the workers' table
    frequent = " ".join(f"f{i:03d} " * 40 for i in range(lm.WORDS))
    tokens, seen = lm.Tokens([f"f{i:03d}" for i in range(lm.WORDS)]), {}
    for i in range(500):
        word = f"r{i}"
        other = seen.setdefault(tokens[word], word)
        if other != word:
            break
    rows = [(0, frequent), (1, other), (2, word), (3, word), (3, word), (4, f"{other} f000"), (5, None)] + [(10 + i, word) for i in range(15)]
    got = lm.pseudo_likelihood(documents(spark, rows, **EXTRA)).collect()
    assert len(got) == len(rows)
    score = {r.doc_id: r.log_likelihood for r in got}
    assert abs(score[2] - score[1] - np.log(18 / 2)) < 1e-6 and score[3] == score[2] and score[5] == 0


def test_remembered_tokens_are_bounded():
    words = [f"f{i:03d}" for i in range(lm.WORDS)]
    tokens = lm.Tokens(words, ["known"])
    for lo in range(0, 250_000, 1000):
        found = tokens.of_words([f"w{i}" for i in range(lo, lo + 1000)])
        assert len(tokens) <= 150_000
    assert found[1:-1].tolist() == lm.Tokens([]).of_words([f"w{i}" for i in range(249_000, 250_000)])[1:-1].tolist()
    assert [tokens[w] for w in words] == list(range(lm.WORDS)) and tokens["known"] // lm.VOCABULARY == 1

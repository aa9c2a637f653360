import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import bpe, decontaminate, lm_score, pii, quality, scratch, toxicity

from .conftest import prose

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_tokens_equal_the_library(spark, odd_docs, vocabulary):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(vocabulary)
    more = spark.createDataFrame([(50, "a<|endoftext|>b  it's  1234 你好\n\n x" + "z" * 3000), (51, "​퟿ 'LL don't"), (52, "a" * 5000)], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(more)
    want = []
    for r in docs.collect():
        ids = known.encode(r.text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(known.decode(ids, skip_special_tokens=False))))
    out = [tuple(r) for r in bpe.round_trip(docs, vocabulary).collect()]
    assert sorted(map(str, out)) == sorted(map(str, want))


def test_encode_then_decode_gives_the_text(odd_docs, no_docs, vocabulary):
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(odd_docs, vocabulary), vocabulary).collect()}
    assert back == {r.doc_id: r.text or "" for r in odd_docs.collect()}
    assert bpe.round_trip(no_docs, vocabulary).count() == 0


def labelled(spark, n=400):
    r = random.Random(1)
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        words = prose(60, i + 1).split()
        if toxic:
            words.insert(r.randrange(60), r.choice(["blockhead", "blockheads!", "Numbskull,"]))
        rows.append((i, " ".join(words), "en", int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")


def test_toxic_documents_are_told_from_others(spark, odd_docs, no_docs):
    docs = labelled(spark)
    labels = docs.select("doc_id", "toxic")
    out = toxicity.toxicity(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert held and sum(r.predicted == r.toxic for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    odd = toxicity.toxicity(odd_docs, labels.limit(0)).collect()
    assert len(odd) == odd_docs.count() and all(r.score is not None for r in odd)
    assert toxicity.toxicity(no_docs, labels).count() == 0


@pytest.mark.parametrize("toxic", [lambda a, b: a == b, lambda a, b: a != b, lambda a, b: a and b])
def test_pairs_count_beyond_single_terms(toxic):
    """Documents are toxic as two terms meet, which no sum of single weights tells; other terms say nothing."""
    r = random.Random(2)
    docs, y = [], []
    for _ in range(3000):
        a, b = r.random() < 0.5, r.random() < 0.5
        others = [20 + i for i in range(40) if r.random() < 0.3]
        docs.append(np.array([3, *([11] if a else []), *([12] if b else []), *others], np.int32))
        y.append(float(toxic(a, b)))
    model = toxicity.fit(docs[:2000], np.array(y[:2000]))
    few = [model["wanted"][d][model["wanted"][d] >= 0] for d in docs[2000:]]
    z = toxicity.machine_scores(np.repeat(np.arange(1000), [len(d) for d in few]), np.concatenate(few), 1000, model["bias"], model["w"], model["v"])
    assert np.mean((z >= 0) == np.array(y[2000:])) > 0.95


def test_leaked_items_are_found_and_others_left_alone(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "Where does the old heron sleep in winter? It sleeps below the mill by the river."), (2, None), (3, ""), (1, "Where does the old heron sleep in winter? It sleeps below the mill by the river.")], "item_id long, text string")
    leak = "WHERE does the old heron, sleep in winter?  It sleeps below the mill by the river"
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame([(60, prose(300) + " " + leak + " " + prose(90, 4)), (61, leak), (62, "Where does the old heron sleep in winter? " + prose(50)), (63, prose(70, 3))], "doc_id long, text string"))
    out = decontaminate.contamination(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in out} == {(60, 1), (61, 1)}
    assert decontaminate.contamination(docs, items.limit(0)).count() == 0
    assert decontaminate.contamination(no_docs, items).count() == 0
    assert decontaminate.without_test_items(spark, docs, items).count() == docs.count() - 2


def test_leaks_of_items_with_one_word_endings(spark):
    """An item's last word may be changed or cut off like any other; a one-word ending proves nothing by itself."""
    body = " ".join(prose(31, 40).split()[:30])
    items = spark.createDataFrame([(1, body + ". Er."), (2, prose(20, 41) + ". " + prose(9, 42) + ". Ñ.")], "item_id long, text string")
    texts = [body + ". Er.", body + ". Sie.", body, body.split(" ", 21)[-1] + " Er. " + prose(30, 43), prose(60, 44) + " Er."]
    docs = spark.createDataFrame([(i, prose(40, 50 + i) + " " + t + " " + prose(20, 60 + i)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.contamination(docs, items).collect()} == {(0, 1), (1, 1), (2, 1)}
    for text in ("", "Er.", "Er. Sie.", "a b c", body + ". Er.", "a. " + body, prose(9) + ". " + prose(12) + "? " + prose(5)):
        question, answer = decontaminate.question_and_answer(text)
        n = len(text.split())
        assert question + answer == text and len(answer.split()) >= min(10, n - n // 2)


@pytest.mark.parametrize("cells", [decontaminate.CELLS, 1])
def test_retrieval_equals_scoring_all_items(spark, monkeypatch, cells):
    """Bounds skip no passage and item at or above the threshold, and let none below pass; items may be of any length."""
    import pyarrow as pa

    monkeypatch.setattr(decontaminate, "CELLS", cells)
    texts = [prose(25 if i % 9 else 150, 100 + i) for i in range(37)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    (found,) = decontaminate.indexes(items)
    assert sorted(index.span for index in found) == [64, 256]
    docs = [prose(150, 7), texts[5] + " " + prose(40, 8), prose(200, 9) + " " + texts[30], "", prose(500, 10) + " " + texts[9] + " " + prose(300, 11), "zzz"]
    tokens = [t.split() for t in texts]
    mean = sum(map(len, tokens)) / len(tokens)
    weights = []
    for t in tokens:
        w = {}
        for x in set(t):
            df, tf = sum(x in u for u in tokens), t.count(x)
            w[x] = math.log(1 + (len(tokens) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t) / mean))
        weights.append({x: v / sum(w.values()) for x, v in w.items()})
    words = decontaminate.words(pa.array(docs), True, True)
    for threshold in (0.3, 0.45, 0.6):
        got, want = {}, {}
        for index in found:
            for d, i, score, *_ in decontaminate.retrieved(words, index, threshold):
                got[d, index.item_ids[i]] = max(score, got.get((d, index.item_ids[i]), 0))
        for i, w in enumerate(weights):
            span = 64 if len(tokens[i]) <= 64 else 256
            for d, t in enumerate(docs):
                t = t.split()
                best = max(sum(v for x, v in w.items() if x in t[a : a + 2 * span]) for a in range(0, len(t) or 1, span))
                if best >= threshold:
                    want[d, i] = best
        assert len(want) >= 3 and got == pytest.approx(want)


def test_other_items_do_not_change_a_passage(spark):
    """A very long item, and items dealt over many broadcasts, leave the hits of the others as they are."""
    items = [(i, prose(30, 700 + i)) for i in range(12)]
    docs = spark.createDataFrame([(i, prose(90, 800 + i) + " " + items[i % 12][1] + " " + prose(90, 900 + i)) for i in range(24)], "doc_id long, text string")
    few, more = (spark.createDataFrame(rows, "item_id long, text string") for rows in (items, [*items, (99, prose(3000, 5))]))
    of = lambda rows: {(r.doc_id, r.item_id) for r in rows.collect()}
    assert {(i, i % 12) for i in range(24)} <= of(decontaminate.contamination(docs, few)) == of(decontaminate.contamination(docs, more))
    assert len(list(decontaminate.indexes(few, 100))) > 1


def test_junk_is_rejected_and_prose_is_kept(spark, odd_docs, no_docs):
    good = [(i, prose(80, i + 1), "en", 1) for i in range(300)]
    bad = [(1000 + i, "".join(random.Random(i).choice("#@$%&XQZ ") for _ in range(400)), "en", 0) for i in range(30)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, lang string, quality int")
    out = quality.quality(docs, docs.select("doc_id", "quality")).collect()
    assert all(r.kept == (r.doc_id < 1000) for r in out)
    none = quality.quality(odd_docs, docs.select("doc_id", "quality").limit(0)).collect()
    assert len(none) == odd_docs.count() and all(r.kept for r in none)
    assert quality.quality(no_docs, docs.select("doc_id", "quality")).count() == 0


def test_stages_judge_rows_without_an_id_and_with_repeated_ids(spark, odd_docs, no_docs):
    """Of rows that share an id, or have none, only those with a text that is junk or holds an item go; columns stay."""
    r = random.Random(3)
    junk = "".join(r.choice("@#$%&XQZ ") for _ in range(400))
    item = " ".join(f"of{k}item" for k in range(40))
    rows = [(i, prose(80, i + 1), "en") for i in range(300)] + [(1000, junk, "en"), (1000, prose(80, 401), "en"), (None, junk, "en"), (None, prose(80, 400), "en"), (None, None, None), (2, item, "en"), (None, item, "en"), (3, "", "en")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, lang string, _id int, judged int")
    labels = spark.range(300).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    kept = quality.keep_good(spark, docs, labels)
    assert kept.columns == docs.columns
    texts = lambda df: sorted((str(r.doc_id), r.text or "") for r in df.collect())
    assert [x for x in texts(kept) if x[1] != item] == sorted((str(i), t or "") for i, t, _ in rows if t not in (junk, item))
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    clean = decontaminate.without_test_items(spark, docs, items)
    assert clean.columns == docs.columns and texts(clean) == sorted((str(i), t or "") for i, t, _ in rows if t != item)
    assert quality.keep_good(spark, no_docs, labels).count() == decontaminate.without_test_items(spark, no_docs, items).count() == 0


def test_one_outlier_does_not_set_a_bound(spark):
    """A trusted document at 2.3 nats a byte among 160 near 1.4 lets no junk at 1.9 pass, in its own language or a rare one."""
    rows = [(i, "de", 2000, 2000 * (1.4 + i / 4000)) for i in range(160)] + [(200, "de", 2000, 4600.0), (300, "de", 2000, 3800.0), (301, "de", 2000, 2900.0)]
    rows += [(400 + i, "sv", 2000, 2800.0 + i) for i in range(60)] + [(500, "sv", 2000, 4600.0), (600, "sv", 2000, 3800.0)]
    scored = spark.createDataFrame([(*row, 0) for row in rows], "doc_id long, lang string, n_bytes long, nats double, judged long")
    kept = {r.doc_id: r.kept for r in quality._judged(scored, scored.filter("doc_id not in (300, 301, 600)").select("doc_id")).collect()}
    assert not kept[300] and not kept[600] and kept[301]
    assert all(kept[i] for i in [*range(160), *range(400, 460)])


def test_trusted_text_has_a_bound_of_its_own(spark):
    rows = [(i, "x" * (50 + i)) for i in range(200)] + [(300, "y" * (quality.LONGEST_TRUSTED + 1)), (301, None), (5, "x" * 55)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    total = sum(len(t) for _, t in rows[:200])
    sizes = {most: [len(r.text) for r in quality._within(texts, most).collect()] for most in (0, 5000, total)}
    assert sizes[0] == [] and 4500 < sum(sizes[5000]) <= 5000 and sorted(sizes[total]) == list(range(50, 250))


def test_all_trusted_text_of_its_half_trains(spark):
    """A trusted text of over a MB is learnt from, and so are more than 6,000 documents."""
    half = F.pmod(F.xxhash64(F.lit("half"), "id"), F.lit(2))
    ids = [r.id for r in spark.range(14_000).filter(half == 0).collect()]
    other = "".join(chr(ord("a") + (i * i + i // 7) % 26) + chr(ord("A") + i % 3) for i in range(20))
    rows = [(ids[0], other * 30_000, "en"), (20_001, other * 3, "en")] + [(i, f"{i * 7919 % 100_003:05d}" * 3, "en") for i in ids[1:]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r.doc_id: r.perplexity for r in quality.quality(docs, docs.filter("doc_id <> 20001").select("doc_id", F.lit(1).alias("quality"))).collect()}
    assert len(ids) > 6500 and out[20_001] < 1.5
    seen = quality._of_ids(docs.select("doc_id", "text"), spark.createDataFrame([(i,) for i in ids], "doc_id long"))
    assert seen.count() == len(ids) and seen.agg(F.sum(F.length("text"))).first()[0] == sum(len(r[1]) for r in rows[:1] + rows[2:])


def test_a_model_in_shards_judges_alike(spark, odd_docs, monkeypatch):
    docs = odd_docs.select("doc_id", "text", "lang").withColumn("judged", quality._judged_by("lang", "text"))
    grams, contexts = quality.kneser_ney(spark.createDataFrame([(prose(60, i),) for i in range(6)], "text string"))
    one = sorted((str(r.doc_id), r.judged, r.n_bytes, r.nats) for r in quality.perplexities(docs, grams, contexts).collect())
    monkeypatch.setattr(quality, "SHARD_KEYS", 1500)
    monkeypatch.setattr(quality, "_SLICE", 1000)
    shards = quality._shards(grams, contexts)
    more = sorted((str(r.doc_id), r.judged, r.n_bytes, r.nats) for r in quality.perplexities(docs, grams, contexts).collect())
    assert len(shards) > 1 and [s[2] for s in shards[1:]] == [s[3] + 1 for s in shards[:-1]] and len(one) == odd_docs.count()
    assert [x[:3] for x in one] == [x[:3] for x in more] and [x[3] for x in one] == pytest.approx([x[3] for x in more])


def test_slices_of_bytes_have_the_same_keys(monkeypatch):
    texts = [b"", b"ab", b"some words", b"", b"x" * 40, b"end"]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    monkeypatch.setattr(quality, "_SLICE", 7)
    parts = list(quality.key_slices(data, offsets, 6))
    assert np.concatenate([k for _, k in parts]).tolist() == quality.gram_keys(data, offsets, 6).tolist()
    assert np.concatenate([of for of, _ in parts]).tolist() == np.repeat(np.arange(len(texts)), np.diff(offsets)).tolist()


def test_kneser_ney_equals_its_definition(spark):
    """Counts, discounts and interpolation in plain Python, over bytes with padding before each text."""
    texts = [prose(30, i) for i in range(4)] + ["alpha", "", "é"]
    grams, contexts = quality.kneser_ney(spark.createDataFrame([(t,) for t in texts], "text string"), 3)
    g, c = quality._collected(grams, "logp"), quality._collected(contexts, "logw")
    model = {n: (quality.Shelf(*g[n], 0.0), quality.Shelf(*c[n], 0.0)) for n in (1, 2, 3)}
    padded = [bytes([10, 10]) + t.encode() for t in texts]
    counts = {3: Counter(t[i - 2 : i + 1] for t in padded for i in range(2, len(t)))}
    for n in (2, 1):
        counts[n] = Counter(k[1:] for k in counts[n + 1])

    def p(gram):
        n = len(gram)
        if n == 0:
            return 1 / 256
        few = [max(1, sum(v == k for v in counts[n].values())) for k in (1, 2, 3, 4)]
        y = few[0] / (few[0] + 2 * few[1])
        d = [min(max(k - (k + 1) * y * few[k] / few[k - 1], 0.05), k - 0.05) for k in (1, 2, 3)]
        same = {k: v for k, v in counts[n].items() if k[:-1] == gram[:-1]}
        if not same:
            return p(gram[1:])
        total, own = sum(same.values()), counts[n].get(gram, 0)
        return (own - (d[min(own, 3) - 1] if own else 0) + sum(d[min(v, 3) - 1] for v in same.values()) * p(gram[1:])) / total

    for text in (texts[0][:60], "alphb", "zzz", texts[2][5:40].upper()):
        data = np.frombuffer(text.encode(), np.uint8)
        got = quality.log_probabilities(quality.gram_keys(data, np.array([0, len(data)]), 3), model)
        t = bytes([10, 10]) + text.encode()
        assert got == pytest.approx([math.log(p(t[i - 2 : i + 1])) for i in range(2, len(t))], abs=1e-3)


def test_kneser_ney_probabilities_add_up(spark):
    texts = spark.createDataFrame([(prose(200, i),) for i in range(5)], "text string")
    grams, contexts = quality.kneser_ney(texts, 3)
    g, c = quality._collected(grams, "logp"), quality._collected(contexts, "logw")
    model = {n: (quality.Shelf(*g[n], 0.0), quality.Shelf(*c[n], 0.0)) for n in (1, 2, 3)}
    for context in (b"al", b"zz", b"\n\n", b"a "):
        keys = np.array([(context[0] << 16) | (context[1] << 8) | x for x in range(256)])
        assert np.exp(quality.log_probabilities(keys, model).astype(float)).sum() == pytest.approx(1, abs=1e-3)


def test_language_model_scores(spark, odd_docs, no_docs):
    docs = labelled(spark, 300).select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    out = sorted(lm_score.lm_scores(docs).collect(), key=lambda r: (str(r.doc_id), r.n_tokens))
    tokens = sorted(((r.doc_id, re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate(LOW)) + [None]) for r in docs.collect()), key=lambda x: (str(x[0]), len(x[1])))
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in tokens]
    c = Counter(w for h, (_, t) in zip(held, tokens) if not h for w in t)
    n, v = sum(c.values()), len(c)
    for r, h, (i, t) in zip(out, held, tokens):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i, h, len(t), sum(c[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), abs=1e-6)
        assert r.score < 0
    assert lm_score.lm_scores(no_docs).count() == 0


def test_language_model_step_matches_plain_loops(monkeypatch):
    rng = np.random.default_rng(3)
    rows = np.minimum(rng.zipf(1.4, (5000, lm_score.FEATURES)), lm_score.ROWS - 1).astype(np.int32)
    rows[:, 1] = rng.integers(0, lm_score.ROWS, 5000)
    label = rng.integers(0, 7, 5000)
    g = rng.normal(size=(5000, 7)).astype(np.float32)
    for f in (0, 1):
        own, times, total = lm_score.summed_by_row(g, rows[:, f])
        want = np.zeros((lm_score.ROWS, 7))
        np.add.at(want, rows[:, f], g.astype(float))
        assert sorted(own) == sorted(set(rows[:, f])) and (times == np.bincount(rows[:, f])[own]).all()
        assert total == pytest.approx(want[own], abs=1e-3)

    monkeypatch.setattr(lm_score, "BATCH", 2000)
    tokens = type("T", (), {"rows": rows, "label": label})()
    prior = np.log(np.full(7, 1 / 7)).astype(np.float32)
    got, met = lm_score.train_on(iter([tokens]), np.zeros((lm_score.ROWS, 7), np.float32), prior)
    w, power, seen = np.zeros((lm_score.ROWS, 7)), np.full(lm_score.ROWS, 1e-2), np.zeros(lm_score.ROWS)
    for a in range(0, 5000, 2000):
        r, y = rows[a : a + 2000], label[a : a + 2000]
        p = np.exp(w[r].sum(axis=1) + prior)
        p = p / p.sum(axis=1, keepdims=True) - np.eye(7)[y]
        for f in range(lm_score.FEATURES):
            for row in set(r[:, f]):
                mine = p[r[:, f] == row]
                step = mine.sum(axis=0) / math.sqrt(len(mine))
                power[row] += (step * step).mean()
                w[row] -= lm_score.RATE * step / math.sqrt(power[row])
                seen[row] += len(mine)
    assert got == pytest.approx(w, abs=1e-3) and (met == seen).all()
    own = lm_score.log_classes(got, prior, rows)[np.arange(5000), label]
    assert lm_score.log_labels(got, prior, rows, label) == pytest.approx(own, abs=1e-5)


def test_words_of_a_class_are_learnt_from_the_words_before(spark, monkeypatch):
    """Words that one class holds, each told by the word before it: counts alone leave them even, decisions do not."""
    batch = lambda texts: pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    r = random.Random(4)
    text = lambda n: " ".join(f"go{i} sam{i}" for i in (r.randrange(8) for _ in range(n)))
    tokens = lm_score.Tokens(batch([text(3000) for _ in range(4)]), np.zeros(0, np.int64))  # a single class beside the ends
    mass = np.zeros((1, 1 << lm_score.LEVELS))
    words_ = tokens.hash[~tokens.is_end]
    for h, c in zip(*np.unique(words_, return_counts=True)):
        mass[0, lm_score.leaf_codes(np.array([h]))[0]] += c + 0.1
    inside = lm_score.Inside(np.zeros(lm_score.PLACES, np.float32), mass)
    assert inside.gains(tokens) == pytest.approx(0, abs=1e-4)  # nothing learnt: as counts say
    assert inside.log_leaves(tokens)[~tokens.is_end] == pytest.approx(np.log(mass[0, tokens.code[~tokens.is_end]] / mass.sum()), abs=1e-4)
    before = inside.weights.copy()
    lm_score.train_on(iter([tokens] * 6), np.zeros((lm_score.ROWS, 2), np.float32), np.log([0.9, 0.1]).astype(np.float32), inside)
    assert (inside.weights != before).any() and inside.met.sum() == 6 * lm_score.FEATURES * lm_score.LEVELS * (~tokens.is_end).sum()
    fresh = lm_score.Tokens(batch([text(500)]), np.zeros(0, np.int64))
    named = np.arange(1, 1000, 2)  # the words that the one before tells
    assert inside.gains(fresh)[named].mean() > 0.5 * math.log(8)

    # leaves of a class add up to 1 after any history
    at = np.full(1 << lm_score.LEVELS, 5)
    every = type("T", (), {"label": np.zeros(len(at), np.int64), "code": np.arange(len(at), dtype=np.int32), "places": fresh.places[at]})()
    assert np.exp(inside.log_leaves(every)).sum() == pytest.approx(1, abs=1e-5)


def test_language_model_scores_what_the_word_before_tells(spark, monkeypatch):
    """Held-out texts whose words follow one another gain over the same words in another order; rare words as common ones do."""
    r = random.Random(8)
    order = lambda n: " ".join(f"go{i} sam{i}" for i in (r.randrange(8) for _ in range(n)))
    mixed = lambda n: " ".join(f"{x}{i}" for x, i in zip(["go", "sam"] * n, (r.randrange(8) for _ in range(2 * n))))
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(i, mixed(60) if i in held[::2] else order(60)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(lm_score, "CLASSES", 1)
    monkeypatch.setattr(lm_score.class_bounds, "__defaults__", (1,))
    out = {x.doc_id: x for x in lm_score.lm_scores(docs).collect()}
    gain = lambda ids: sum(out[i].score - out[i].base_score for i in ids) / len(ids)
    assert gain(held[1::2]) > gain(held[::2]) + 5
    monkeypatch.setattr(lm_score, "COMMON", 4)
    rare = {x.doc_id: x.score for x in lm_score.lm_scores(docs).collect()}
    assert rare == pytest.approx({i: x.score for i, x in out.items()}, abs=1e-6)


def test_rare_words_are_joined_when_they_do_not_fit(spark, monkeypatch):
    docs = labelled(spark, 60).select("doc_id", "text")
    want = {r.doc_id: r.base_score for r in lm_score.lm_scores(docs).collect()}
    monkeypatch.setattr(lm_score, "COMMON", 10)
    got = {r.doc_id: r.base_score for r in lm_score.lm_scores(docs).collect()}
    assert got == pytest.approx(want)


PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and sum(int(x) if k % 2 == 0 else sum(map(int, str(2 * int(x)))) for k, x in enumerate(digits[::-1])) % 10 == 0
    return 9 <= len(digits) <= 15 if kind == "phone" else True


def test_personal_data_spans(spark, odd_docs, no_docs):
    r = random.Random(6)
    odd = [
        "a@b.c_d@e.f -x@y.z x@@y.z a@b..c é@b.co ñ a.b@c-d.e.f@g.h", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.0255 1..2.3.4", "4111 1111 1111 1111 4111-1111-1111-1112 0000000000000 1 2 3",
        "+1 (377) 555-0271 ++49 30 1234567) +12 +123456789012345678 +1-2-3-4-5-6-7-8-9.", "9" * 30_000, "1 " * 20_000, "a" * 50_000 + "@", "+" * 1000 + "1", "@" * 100, "\U0001f600 x@y.zz 1.1.1.1",
    ]
    odd += ["".join(r.choice("a1.@+- ()_é") for _ in range(200)) for _ in range(150)]
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame([(200 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    out = sorted(str((x.doc_id, x.n_email, x.n_ip, x.n_card, x.n_phone, x.base_sha256)) for x in pii.personal_data(docs).collect())
    want = []
    for x in docs.collect():
        spans = [(k, m.start(), m.end()) for k, p in PATTERNS for m in re.finditer(p, x.text or "") if holds(k, m.group())]
        n = Counter(k for k, _, _ in spans)
        want.append(str((x.doc_id, n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest())))
    assert out == sorted(want)
    assert pii.personal_data(no_docs).count() == 0


def test_terms_that_give_an_entity_away_are_marked(spark):
    texts = [(i, f"{prose(30, i)} write to Quentin Zanzibar at q@z.example now {prose(30, i + 500)}") for i in range(6)] + [(100 + i, prose(60, i + 900) + " at now") for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    out = {r.doc_id: r for r in pii.personal_data(docs, texts=True).collect()}
    hidden = out[0].sanitised
    assert "[EMAIL]" in hidden and "Zanzibar" not in hidden and "q@z" not in hidden and " now " in hidden
    assert out[100].sanitised == texts[6][1] and out[100].spans == ""


def _disclosed(docs):
    """Spans of disclosing terms of (id, text) by plain loops."""
    near, spans = Counter(), {}
    docs_of, entities = {}, {}
    for i, text in docs:
        for t in {w for w in re.split(r"[\W\d_]+", text.lower()) if len(w) >= 3}:
            docs_of[t] = docs_of.get(t, 0) + 1
        base = [(k, m.start(), m.end(), m.group()) for k, p in PATTERNS for m in re.finditer(p, text) if holds(k, m.group())]
        found = set()
        for k, a, b, v in base:
            at = max(a - pii.NEAR, 0)
            for m in re.finditer(r"[^\W\d_]{3,}", text[at : at + b - a + 2 * pii.NEAR]):
                s, e = at + m.start(), at + m.end()
                if not any(x < e and y > s for _, x, y, _ in base):
                    found.add((f"{k}:{v.lower()}", m.group().lower(), s, e))
        spans[i] = found
        for pair in {f[:2] for f in found}:
            near[pair] += 1
        for entity in {f[0] for f in found}:
            entities[entity] = entities.get(entity, 0) + 1
    n, out = len(docs), {}
    for i, found in spans.items():
        best = {}
        for entity, term, s, e in found:
            if near[entity, term] >= pii.SUPPORT:
                own = math.log2(n / entities[entity])
                share = math.log2(near[entity, term] * n / (entities[entity] * docs_of[term])) / own if own > 0 else 0
                best[s, e] = max(best.get((s, e), 0), share)
        kinds = [("removed" if x >= pii.REMOVE else "general", s, e) for (s, e), x in best.items() if x >= pii.GENERALISE]
        out[i] = [f"{k}:{s}:{e}" for k, s, e in sorted(kinds)]
    return out


def test_disclosed_terms_equal_plain_loops(spark):
    r = random.Random(4)
    people = [(f"Name{chr(97 + i) * 3}", f"u{i}@m.example", f"10.0.0.{i}") for i in range(8)]
    docs = []
    for i in range(90):
        words = prose(40, i).split()
        for name, mail, ip in r.sample(people, r.randrange(3)):
            at = r.randrange(len(words))
            words[at:at] = [r.choice([name, "Straße" + name, name + "ñ"]), mail, *([f"é{mail}", ip] if r.random() < 0.4 else [])]
        docs.append((i, " ".join(words)))
    docs += [(200 + i, " ".join(f"w{j}@a.bc Pat" for j in range(400))) for i in range(2)]
    got = {x.doc_id: [s for s in x.spans.split(",") if s[:3] in ("gen", "rem")] for x in pii.personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    want = _disclosed(docs)
    assert any(want.values()) and got == {i: sorted(w, key=lambda s: (s.split(":")[0], int(s.split(":")[1]))) for i, w in want.items()}


def test_a_text_of_very_many_addresses_takes_seconds(spark):
    text = " ".join(f"Name user{i}@mail{i % 50}.example" for i in range(20_000))
    start = time.perf_counter()
    row = pii.personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_email == 20_000 and time.perf_counter() - start < 90


def test_pipeline_on_small_tables(spark):
    import corpus_pipeline

    from ..helpers import SMALL

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.save(stage(spark, docs, SMALL))
        assert out.columns == docs.columns and out.count() <= docs.count()
        assert name != "line_dedup" or out.count() == docs.count()
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert last.count() == docs.count() == last.select("doc_id").distinct().count()
    assert F.col("doc_id") is not None


def test_spans_of_a_text_of_many_matches(spark):
    """Places at and beyond the ends of the blocks that matches are walked in."""
    for n in (1, 127, 128, 129, 20_000):
        text = " é ".join(f"a{i}@b{i % 7}.ex" for i in range(n))
        got = spark.createDataFrame([(text,)], "t string").select(pii.found_spans(F.col("t"), pii.PATTERNS["email"]).alias("s")).first().s
        assert [(x.start, x.end, x.value) for x in got] == [(m.start(), m.end(), m[0]) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", text)]


def test_steps_give_memory_back_and_let_go_of_models(spark, odd_docs, monkeypatch, vocabulary):
    given = []
    monkeypatch.setattr(scratch, "give_back", lambda: given.append(1))
    scratch.held("a model", lambda: 1)
    run = lambda batches: (b for b in batches)
    assert list(scratch.tidy(run, model=True)(iter("ab"))) == ["a", "b"]
    assert len(given) == 3 and "a model" in scratch._held
    assert list(scratch.tidy(run)(iter("ab"))) == ["a", "b"]
    assert len(given) == 6 and not scratch._held

    # a worker that has encoded holds no vocabulary once it counts n-grams
    def held_now(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(scratch._held)] * len(b), pa.int64())], ["n"])

    docs = odd_docs.select("doc_id", "text").coalesce(1)
    bpe.round_trip(docs, vocabulary).collect()
    quality.counted_grams(docs, 3).collect()
    assert {r.n for r in docs.mapInArrow(scratch.tidy(held_now), "n long").collect()} == {0}

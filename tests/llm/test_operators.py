"""The training-data operators against brute force, SQL and planted cases."""

import binascii
import collections
import itertools
import math
import os
import random
import re
import time
import tracemalloc

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from claimsflow.llm import (catalog, chat, common, decontaminate, language, language_model, mixing, near_duplicates, pii, quality,
                            toxicity, urls)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars int, node string, `row` int, spans string, text_key string, w double, root int"
LONG = " ".join(f"word{k % 977}" for k in range(60_000))
BASE = "The cat sat on the mat and looked at the moon while nobody else was there to see it at all tonight in town"


def odd_rows(spark):
    rows = [(1, BASE, "en", "a.example.com"), (1, BASE, "en", "a.example.com"), (2, BASE + " .", "en", "a.example.com"), (3, None, "en", None), (4, "", None, "src"),
            (5, " \n\t ", "xx", ""), (None, "Un texte sans nom et sans lieu mais avec des mots pour tous les gens", "fr", "src"), (6, LONG, "en", "src"),
            (7, "héé ☃ \U0001F600 l'été", None, None), (8, "mail a.b@example.com or 10.0.0.1 and 4111 1111 1111 1111", "en", "src")]
    return spark.createDataFrame([(*r, None, "x", 1, "y", "z", 0.5, 3) for r in rows], DOCS)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


LABELS = [(1, 1, 0), (1, 1, 0), (2, 0, 1), (2, 1, 0), (None, 1, 1), (8, None, None)]
BENCH = [(1, "If Anna has 12 apples and Bob has 7 apples, how many apples do Anna and Bob have together?"), (2, None), (3, ""), (4, "too short"), (None, BASE)]


def run_all(spark, docs, labels, bench):
    return {
        "mix": mixing.mix(docs), "lm": language_model.score(docs), "join": near_duplicates.join(docs), "one": near_duplicates.keep_one(docs),
        "leaks": decontaminate.leaks(docs, bench), "clean": decontaminate.clean(docs, bench), "language": language.identify(language.of_documents(docs)),
        "quality": quality.judge(docs, labels), "pii": pii.find(docs, np.zeros((pii.N_FEATURES, len(pii.KINDS))) - 1),
        "redact": pii.redact(docs, np.zeros((pii.N_FEATURES, len(pii.KINDS))) - 1), "toxic": toxicity.score(docs, toxicity.fit(docs, labels)),
    }


def test_odd_rows_have_defined_results(spark):
    docs = odd_rows(spark)
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    out = {k: v.collect() for k, v in run_all(spark, docs, labels_of(spark, LABELS), bench).items()}
    assert {k: len(v) for k, v in out.items() if k not in ("one", "leaks", "clean")} == dict.fromkeys(
        ("mix", "lm", "join", "language", "quality", "pii", "redact", "toxic"), 10)
    by = lambda k, i: [r for r in out[k] if r.doc_id == i]
    # copies and the near copy are one class; texts without words are alone
    assert {r.class_id for i in (1, 2) for r in by("join", i)} == {1} and by("join", 3)[0].class_id == 3 and by("join", 5)[0].n_links == 0
    assert sorted(r.doc_id or 0 for r in out["one"]) == [0, 1, 3, 4, 5, 6, 7, 8] and set(out["one"][0].asDict()) == set(docs.columns)
    assert {(r.doc_id, r.item_id) for r in out["leaks"]} == {(1, None), (2, None)}
    assert sorted(r.doc_id or 0 for r in out["clean"]) == [0, 3, 4, 5, 6, 7, 8]
    assert not by("language", 3)[0].kept and by("language", 3)[0].language is None
    assert all(by("quality", i)[0].base_failed and not by("quality", i)[0].kept for i in (3, 4, 5))
    assert by("pii", 8)[0].n_email == by("pii", 8)[0].n_ip == by("pii", 8)[0].n_card == 1 and by("pii", 3)[0].spans == ""
    assert by("redact", 8)[0].text == "mail <EMAIL> or <IP> and <CARD>" and by("redact", 3)[0].text is None
    assert by("lm", 3)[0].n_tokens == 1 == by("lm", 4)[0].n_tokens and by("lm", 6)[0].n_tokens == 60_001
    assert len({r.score for r in by("lm", 1)}) == 1 and all(0 <= r.score <= 1 for r in out["toxic"])


def test_empty_tables(spark):
    docs = odd_rows(spark).limit(0)
    out = run_all(spark, docs, labels_of(spark, []), spark.createDataFrame([], "item_id long, text string"))
    assert all(df.count() == 0 for df in out.values())
    said = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.rotate(said).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judge(pages, labels_of(spark, [])).count() == 0 == language.identify(language.of_pages(pages)).count()


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    con.execute(f"CREATE VIEW answer AS {catalog.SQL[name]}")
    found = catalog.QUERIES[name](spark, SF)
    names = ", ".join(sorted(found.columns))
    want = con.execute(f"SELECT {names} FROM answer").fetchall()
    assert sorted(map(tuple, found.select(*sorted(found.columns)).collect()), key=repr) == sorted(want, key=repr)


# ---- 1 ----

def test_raked_margins_meet_their_targets(spark):
    rows = [(k, "w " * (1 + k % 7), ("en", "de")[k % 3 == 0], f"s{k % 4}") for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    mixed = mixing.mix(docs).toPandas()
    total = mixed.n_tokens.sum()
    for m in ("source", "lang"):
        share = mixed.groupby(m).n_tokens.sum() ** 0.5
        got = (mixed.n_tokens * mixed.weight).groupby(mixed[m]).sum() / total
        assert np.allclose(got, share / share.sum(), atol=1e-6)
    assert abs((mixed.probability * mixed.n_tokens).sum() - total / 2) < 1e-6 * total


def test_given_targets_hold_for_the_categories_that_have_tokens(spark):
    docs = common.table(spark, SF, "documents")
    shares = lambda m, rows: spark.createDataFrame(rows, f"{m} string, target double")
    names = [r[0] for r in docs.where("source IS NOT NULL").select("source").distinct().orderBy("source").collect()]
    out = names[0]
    targets = {"source": shares("source", [(n, 1.0) for n in names[1:]] + [("nowhere", 5.0)]), "lang": shares("lang", [("en", 3.0), ("de", 1.0)]),
               "topic": mixing.tempered_targets(mixing.counted(docs).groupBy("topic").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"), "topic")}
    mixed = mixing.mix(docs, targets, rate=0.05).toPandas()
    assert not mixed[(mixed.source == out) & (mixed.n_tokens > 0)].sampled.any()
    left = mixed[mixed.n_tokens > 0]
    drawn = (left.n_tokens * left.weight).groupby(left.lang).sum() / left.n_tokens.sum()
    assert set(drawn[drawn > 0].index) == {"en", "de"} and (mixed.probability <= 1).all()


@pytest.mark.parametrize("on_driver", [0, 1000])
def test_slow_margins_are_met_and_contradictions_are_reported(spark, on_driver):
    def raked(rows, **more):
        cells = spark.createDataFrame([(s, m, "t", n) for s, m, n in rows], "source string, lang string, topic string, tokens long")
        targets = {m: mixing.tempered_targets(cells, m) for m in mixing.MARGINS}
        out, error = mixing.rake(cells, targets, on_driver=on_driver, **more)
        w = out.toPandas()
        return max(abs(w.groupby(m).w.sum()[r[m]] / r.target - 1) for m in mixing.MARGINS for r in targets[m].collect()), error

    # each source mainly in one language: 24 sweeps leave a margin over 1 % off
    slow = [(f"s{k}", ("en", "de")[(k + x) % 2], (30, 900_000 * (k + 1) ** 2)[x == 0]) for k in range(4) for x in (0, 1)]
    if on_driver:
        assert raked(slow, sweeps=24)[0] > 0.01
        off, error = raked(slow)
        assert off < 1e-8 and error <= mixing.TOLERANCE
    # two sources, each the only one of its language: no weights have both margins
    off, error = raked([("a", "en", 900), ("b", "de", 100), ("c", "de", 400)])
    assert error > 0.01 and off > 0.01


# ---- 2 ----

def test_base_scores_match_brute_force_and_model_sums_to_one(spark):
    docs = common.table(spark, SF, "documents")
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    words = lambda t: [*t.encode().lower().split(), b""]
    out = lambda i: binascii.crc32(str(i).encode()) % 5 == 1
    c = collections.Counter(w for i, t in texts if not out(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    for r in language_model.op2_lm_scoring(spark, SF).collect():
        w = words(dict(texts)[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out(r.doc_id), len(w), sum(c[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), rel_tol=1e-9)
        assert r.score < 0


def test_model_probabilities_sum_to_one_and_windows_do_not_matter():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 50, 700).astype(float)
    windows = rng.integers(0, 700, (300, language_model.SAMPLE_IDS + 1)).astype(np.int32)
    model = language_model.Model(counts, language_model.id_classes(windows, counts, np.arange(700) % 2 == 0))
    model.train(windows, rounds=1)
    every = model.log_probability(np.arange(700), np.arange(701), 699)
    assert math.isclose(np.exp(every).sum(), 1.0, rel_tol=1e-3)
    # each id is scored once, whatever the batches and the texts around it
    ids = rng.integers(0, 700, 150)
    alone = model.log_probability(ids, np.array([0, 150]), 699, batch=3)
    beside = model.log_probability(np.concatenate([ids, ids[:40]]), np.array([0, 150, 190]), 699)
    assert np.allclose(alone[0], beside[0], rtol=1e-4)


def test_gradients_are_the_slopes_of_the_loss():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 50, 700).astype(float)
    windows = rng.integers(0, 700, (40, language_model.SAMPLE_IDS + 1)).astype(np.int32)
    windows[::3, 50:] = -1  # padding
    model = language_model.Model(counts, language_model.id_classes(windows, counts, np.arange(700) % 2 == 0))
    model.train(windows, rounds=1, batch=32)
    x, valid, target, _ = model.steps(windows[:, :-1].ravel(), windows[:, 1:].ravel(), np.arange(0, windows[:, 1:].size + 1, language_model.SAMPLE_IDS))
    tables = model.tables()
    texts = [w[1:][w[1:] >= 0] for w in windows]

    def loss(moved):
        model.keep(moved)
        before, goal = windows[:, :-1], windows[:, 1:]
        total = 0.0  # the text before each window's ids is its first id
        for b, g in zip(before, goal, strict=True):
            n = (g >= 0).sum()
            total -= model.log_probability(g[:n], np.array([0, n]), b[0])[0]
        return total / sum(map(len, texts))

    rows_of = {k: (slice(None) if rows is None else rows, g) for k, (rows, g) in model.gradients(tables, x, valid, target).items()}
    for k, (rows, g) in rows_of.items():
        step = np.zeros_like(tables[k])
        step[rows] = g / np.sqrt((g * g).sum())
        up, down = (loss(tables | {k: tables[k] + e * step}) for e in (0.05, -0.05))
        assert math.isclose((up - down) / 0.1, float((g * step[rows]).sum()), rel_tol=0.03), k


def test_rows_of_one_input_are_summed_together():
    rng = np.random.default_rng(4)
    at = (4000 * rng.random(16_384) ** 4).astype(np.int32)  # few inputs with many rows, many with few
    values = rng.normal(0, 1, (len(at), 64)).astype(np.float32)
    order = language_model._order(at)
    seconds = []
    for sums in (lambda: np.add.reduceat(values[order], np.flatnonzero(np.diff(at[order], prepend=-1)), axis=0),
                 lambda: language_model._sum_runs(values, at, order)[1]):
        sums()
        start = time.thread_time()
        for _ in range(5):
            found = sums()
        seconds.append(time.thread_time() - start)
    keys, own = language_model._sum_runs(values, at, order)
    assert keys.tolist() == sorted(set(at.tolist())) and np.array_equal(own, found)
    wanted = np.zeros((4000, 64))
    np.add.at(wanted, at, values.astype(float))
    assert np.allclose(own, wanted[keys], atol=1e-3)
    assert seconds[1] < 0.8 * seconds[0]  # a step of training has four such sums
    assert [len(a) for a in language_model._sum_runs(values[:0], at[:0], at[:0])] == [0, 0]


def test_context_is_learned_from_all_training_rows(spark, monkeypatch):
    # the start is fitted to one document only; the others must still count
    monkeypatch.setattr(language_model, "SAMPLE_DOCS", 1)
    rng = random.Random(8)
    pool = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in ("lar", "men", "tos", "rin")]
    rows = [(k, " ".join(rng.choice(pool) for _ in range(40))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path, train = language_model.VOCABULARY, docs.where(~language_model.held_out())
    ids = language_model.subword_counts(language_model.word_counts(train), path)
    pieces = language_model.pieces_of(train, path)
    sub, pairs = language_model.subwords(path), collections.Counter()
    for r in train.collect():
        own = [sub.end, *sub.flat(sub.entries([*r.text.encode().split(), b""]))[0].tolist()]
        pairs.update(zip(own[:-1], own[1:], strict=True))
    near = language_model.Neighbours(ids)
    model = language_model.Model(ids, language_model.classes_by(near, language_model.pair_counts(pieces, near.cells, math.prod(near.shape)), ids, sub.opens))
    wanted = collections.Counter()
    for (a, b), n in pairs.items():
        wanted[int(model.cells(np.array([a]), np.array([b]))[0])] += n
    got = language_model.pair_counts(pieces, model.cells, model.p["B"].size)
    assert {k: v for k, v in enumerate(got) if v} == wanted and got.sum() == ids.sum()
    # every window is trained on, whatever the files and the shards
    moved = []
    for parts in (1, 7):
        monkeypatch.setattr(language_model, "ROUNDS", 2)
        again = language_model.Model(ids, model.classes)
        language_model.refine(again, pieces.repartition(parts), shard_ids=4000)
        moved.append(again.p)
    assert all(np.allclose(moved[0][k], moved[1][k], atol=1e-5) for k in moved[0])
    assert len(language_model.windows_of([r.ids for r in pieces.collect()])) == sum(-(-r.n // language_model.SAMPLE_IDS) for r in pieces.collect())
    seen = [i for i in np.argsort(-ids)[:language_model.INPUTS] if ids[i] > 0]
    assert (moved[0]["E"][again.inputs[seen]] != model.p["E"][again.inputs[seen]]).any(axis=1).all()


# ---- 3 ----

def sets_of(rows):
    out = {}
    for i, t in rows:
        w = t.encode().lower().split()
        n = min(5, len(w))
        out[i] = frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if w else frozenset()
    return out


def test_join_matches_brute_force_in_a_hot_group(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    rows = []
    base = [rng.choice(words) for _ in range(80)]
    for k in range(220):  # many near copies of one text, some further apart than others
        own = list(base)
        for _ in range(rng.choice((0, 1, 1, 2, 3))):
            own[rng.randrange(80)] = rng.choice(words)
        rows.append((k, " ".join(own)))
    rows += [(300 + k, " ".join(rng.choice(words) for _ in range(60))) for k in range(60)]
    monkeypatch.setattr(near_duplicates, "BLOCK", 64)  # several blocks for the hot group
    got = {r.doc_id: r for r in near_duplicates.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = sets_of(rows)
    groups = collections.defaultdict(list)
    for i, s in sets.items():
        groups[s].append(i)
    reps = list(groups)
    links = [(a, b) for a in range(len(reps)) for b in range(a) if 10 * len(reps[a] & reps[b]) >= 8 * len(reps[a] | reps[b])]
    parent = list(range(len(reps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    count = collections.Counter(x for pair in links for x in pair)
    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    named = collections.defaultdict(lambda: 10**9)
    for k, s in enumerate(reps):
        named[find(k)] = min(named[find(k)], *groups[s])
    for k, s in enumerate(reps):
        for i in groups[s]:
            assert (got[i].class_id, got[i].n_links, got[i].n_copies) == (named[find(k)], count[k], len(groups[s]))


def test_pairs_that_16_bands_miss_are_linked(spark):
    # 9 shingles each, 8 of them in both texts: similarity 0.8
    texts, missed = [], 0
    for k in range(12_000):
        words = [f"w{k}x{i}" for i in range(14)]
        a, b = " ".join(words[:13]), " ".join(words[1:])
        m = [near_duplicates.minhash(s)[:64].reshape(16, 4) for s in near_duplicates.shingles([a.encode(), b.encode()])]
        if not (m[0] == m[1]).all(axis=1).any():
            missed += 1
            texts += [(2 * k, a), (2 * k + 1, b)]
    assert missed
    got = near_duplicates.join(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert all(r.n_links == 1 and r.class_id == r.doc_id // 2 * 2 for r in got)


def test_fewest_matches_is_the_posterior_bound():
    for n in (8, 32, 64):
        m = near_duplicates.fewest_matches(n)
        grid = (np.arange(200_000) + 0.5) / 200_000

        def above(k, n=n, grid=grid):
            density = grid**k * (1 - grid) ** (n - k)
            return density[grid >= 0.8].sum() / density.sum()

        assert above(m) >= near_duplicates.TOLERANCE * 0.99 and (m == 0 or above(m - 1) < near_duplicates.TOLERANCE * 1.01)


# ---- 4 ----

def test_perspectives_and_masks(spark):
    rows = [(1, 0, "system", "Be <|kind|>"), (1, 1, "ann", "hi"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, "cy", "☃"), (None, None, None, "x"), (2, 0, "system", "alone")]
    rows += [(9, k, ("ann", "bob")[k % 2], f"t{k}") for k in range(700)]
    out = chat.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("n", F.lit(1))).collect()
    one = {r.perspective: r for r in out if r.conv_id == 1}
    assert set(one) == {"ann", "bob", "cy"} and one["bob"].n_turns == 4
    assert one["cy"].rendered == ("<|system|>\nBe <\\|kind|><|end|>\n<|user name=ann|>\nhi<|end|>\n<|user name=bob|>\n<|end|>\n<|assistant|>\n☃<|end|>\n")
    assert [one["cy"].rendered[m.start:m.end] for m in one["cy"].mask] == ["☃<|end|>\n"]
    assert [r.perspective for r in out if r.conv_id is None] == ["unknown"] and not [r for r in out if r.conv_id == 2]
    hot = sorted((r for r in out if r.conv_id == 9 and r.perspective == "ann"), key=lambda r: (r.part, r.place))
    assert [r.n_turns for r in hot] == [256, 256, 188]
    assert re.findall(r"t\d+", "".join(r.rendered for r in hot)) == [f"t{k}" for k in range(700)]
    assert all("t" + str(2 * j) == r.rendered[m.start:m.end].split("<")[0] for r in hot[:1] for j, m in enumerate(r.mask))


# ---- 5 ----

def test_leaks_with_other_values_need_consistent_slots(spark):
    bench = spark.createDataFrame(BENCH[:1], "item_id long, text string")
    asked = "If Carl has 5 apples and Dora has 9 apples, how many apples do {} and Dora have together?"
    rows = [(1, "A line. " + asked.format("Carl") + " Well."), (2, asked.format("Eve")), (3, BENCH[0][1].upper()), (4, "No such question about apples here, my friend."), (5, BENCH[0][1][:30])]
    got = {(r.doc_id, r.verbatim) for r in decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert {i for i, _ in got} >= {1} and 2 not in {i for i, _ in got} and not {4, 5} & {i for i, _ in got}
    assert (1, False) in got


def test_leaks_match_plain_search(spark):
    docs, bench = common.table(spark, SF, "documents"), common.table(spark, SF, "benchmark")
    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = {r.item_id: plain(r.text) for r in bench.collect()}
    wanted = {(r.doc_id, i) for r in docs.collect() for i, t in items.items() if t in plain(r.text)}
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()} == wanted


# ---- 6 ----

def test_language_follows_text_and_host(spark):
    found = language.op6_language_id(spark, SF).collect()
    assert sum(r.language == r.declared for r in found) > 0.95 * len(found) and sum(r.kept for r in found) > 0.95 * len(found)


def test_posterior_matches_plain_code(spark):
    """Five languages, one of them in no list, against plain Python."""
    rng = random.Random(6)
    vocab = {"en": "the of and house with water light every morning", "pt": "uma casa com agua luz manhã também não coração", "de": "das haus mit wasser licht jeden morgen und",
             "nl": "het huis met water licht elke ochtend een", "fr": "la maison avec eau lumière chaque matin où"}
    hosts = ["a.site.pt", "b.site.pt", "news.de", "plain", None, "x.org"]
    rows = []
    for k in range(260):
        true = sorted(vocab)[k % 5]
        text = " ".join(rng.choice(vocab[true].split()) for _ in range(rng.choice((1, 3, 30))))
        told = rng.choice((true, true, true + "-XX", true.upper(), None, rng.choice(sorted(vocab)), "q" + chr(97 + k % 26), "a language"))
        rows.append((k, text if k % 40 else (None, "", "12 34")[k % 3], told, rng.choice(hosts)))
    df = spark.createDataFrame(rows, "doc_id long, text string, declared string, host string")
    got = {r.doc_id: r for r in language.identify(df).collect()}

    def code(x):
        x = (x or "").strip().split("-")[0].lower()
        return x if re.fullmatch("[a-z]{2}", x) else None

    declared = collections.Counter(code(d) for _, t, d, _ in rows if t is not None)
    langs = sorted(x for x, n in declared.items() if x and n >= language.MIN_DECLARED)
    assert langs == sorted(vocab)
    bins = {k: language.trigram_bins([(t or "").encode()])[0] for k, t, _, _ in rows}
    seen = {x: collections.Counter() for x in langs}
    for k, _, d, _ in rows:
        if code(d) in seen:
            seen[code(d)].update(bins[k].tolist())
    total = {x: sum(c.values()) + 0.5 * language.BINS for x, c in seen.items()}
    ll = {k: [sum(math.log((seen[x][b] + 0.5) / total[x]) for b in bins[k].tolist()) / max(1, len(bins[k])) for x in langs] for k, _, _, _ in rows}
    guess = {k: max(range(5), key=lambda j: ll[k][j]) for k in ll if len(bins[k])}
    parts = {k: (h, ".".join(h.split(".")[-2:]) if h and "." in h else None, h.split(".")[-1] if h and "." in h else None) for k, _, _, h in rows}

    def smoothed(level, key, parent, strength):
        n = [sum(g == j and (level is None or parts[k][level] == key) for k, g in guess.items()) for j in range(5)]
        return [(c + strength * p) / (sum(n) + strength) for c, p in zip(n, parent, strict=True)]

    base = smoothed(None, None, [0.2] * 5, 1.0)
    for k, text, d, h in rows:
        r = got[k]
        if not len(bins[k]):
            assert (r.language, r.kept) == (None, False)
            continue
        prior = base
        if h:
            for level, key in ((2, parts[k][2]), (1, parts[k][1]), (0, h)):
                prior = smoothed(level, key, prior, language.HOST_STRENGTH) if key else prior
        score = []
        for j in range(5):
            told = 1.0
            if code(d) in langs:
                at = [sum(code(rows[x][2]) == lang and guess.get(x) == j for x in guess) for lang in langs]
                told = (at[langs.index(code(d))] + 2.0 * (1 if langs[j] == code(d) else 0.75 / 4)) / (sum(at) + 2.0 * 1.75)
            score.append(min(len(bins[k]), language.TEXT_WEIGHT) * ll[k][j] + math.log(prior[j]) + math.log(told))
        posterior = 1 / sum(math.exp(x - max(score)) for x in score)
        assert math.isclose(r.posterior, posterior, rel_tol=1e-3), k
        best = max(range(5), key=lambda j: score[j])
        assert r.language == langs[best]
        assert r.kept == (r.posterior >= 0.5 and ll[k][best] + 5 / math.sqrt(len(bins[k])) >= -math.log(language.BINS) + 0.5)
    long = [k for k, t, _, _ in rows if t and len(t.split()) == 30]
    assert sum(got[k].language == sorted(vocab)[k % 5] for k in long) > 0.95 * len(long)


def test_language_of_pages(spark):
    found = language.language_of_pages(spark, SF)
    assert found.columns == ["page_id", "language", "posterior", "declared", "host", "kept"]
    rows = found.collect()
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    assert len(rows) == pages.count()
    told = [r for r in rows if r.declared and r.language]
    assert len(told) > 0 and sum(r.language == r.declared for r in told) > 0.8 * len(told)


# ---- 7 ----

def test_statistics_match_plain_code():
    rng = random.Random(2)
    for _ in range(150):
        text = "".join(rng.choice("aB \n#$é") for _ in range(rng.randrange(200))) + " x y z w v u t s" * rng.randrange(3)
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        seen = collections.Counter(tuple(words[k:k + 8]) for k in range(len(words) - 7))
        covered = {k + j for k in range(len(words) - 7) if seen[tuple(words[k:k + 8])] > 1 for j in range(8)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        got = quality.text_stats(text)
        assert got[:5] == (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_cutoffs_hold_the_risk():
    assert math.isclose(quality.binomial_cdf(3, 10, 0.3), sum(math.comb(10, k) * 0.3**k * 0.7 ** (10 - k) for k in range(4)))
    counts = [("en", "symbols", 0, 1, 5000), ("en", "symbols", 9, 0, 300), ("de", "symbols", 0, 1, 20), ("de", "symbols", 9, 0, 9)]
    chosen = quality.choose_cutoffs(counts, 5, 5)
    assert chosen == {("en", "symbols"): quality.GRID[0]}  # too few labels for "de"
    assert not quality.choose_cutoffs([("en", "symbols", 5, 1, 2500), ("en", "symbols", 5, 0, 2600)], 5, 5)
    # 700 good labels do: 0.99 ** 700 is under 0.05 / 25, not under 0.05 / (25 * 17)
    assert quality.choose_cutoffs([("en", "symbols", 0, 1, 700), ("en", "symbols", 9, 0, 30)], 5, 5) == {("en", "symbols"): quality.GRID[0]}
    # an order tested to its end hands its part on: of two, the second is open to 0.05
    first, second = [("en", "a", 0, 1, 5000), ("en", "a", 9, 0, 5)], [("en", "b", 0, 1, 62), ("en", "b", 9, 0, 5)]
    assert not quality.choose_cutoffs(second, 1, 2, risk=0.1) and ("en", "b") in quality.choose_cutoffs(first + second, 1, 2, risk=0.1)
    # the order stops at the first cutoff that fails: none beyond it is looked at
    split = [("en", "symbols", 0, 1, 5000), ("en", "symbols", 6, 1, 400), ("en", "symbols", 9, 0, 900)]
    assert quality.choose_cutoffs(split, 5, 5) == {("en", "symbols"): quality.GRID[6]}


def test_false_rejections_stay_within_the_risk():
    """Labels drawn with a known rate beyond every cutoff: a chosen cutoff that loses
    more than its share of good documents may come up in ``DELTA`` of the draws."""
    rng = np.random.default_rng(7)
    rate = np.linspace(0.03, 0.002, len(quality.GRID))  # good documents beyond each cutoff
    steps = -np.diff(np.concatenate([[1.0], rate, [0.0]]))
    wrong = used = 0
    for _ in range(300):
        counts = []
        for stratum in quality.STRATA:
            good = rng.multinomial(3000, steps)
            counts += [(stratum, "symbols", at, 1, int(n)) for at, n in enumerate(good)] + [(stratum, "symbols", len(quality.GRID), 0, 2000)]
        chosen = quality.choose_cutoffs(counts, len(quality.STRATA), 5)
        used += len(chosen)
        wrong += any(rate[quality.GRID.index(c)] > quality.RISK / 5 for c in chosen.values())
    assert used > 300 and wrong <= 0.1 * 300


def test_verdicts_match_plain_code(spark):
    """``kept`` end to end against plain Python: statistics, cutoffs by a search of
    every level and cutoff, verdicts."""
    rng = random.Random(5)
    rows, told = [], []
    for k in range(2600):
        words = [f"w{rng.randrange(900)}" for _ in range(rng.randrange(15, 40))]
        bad = k % 9 == 0
        for _ in range(rng.randrange(6, 12) if bad else rng.randrange(0, 2) * (k % 50 == 0)):
            words.insert(rng.randrange(len(words)), "$$$$")
        rows.append((k, " ".join(words), ("en", "en", "de", "xx")[k % 4]))
        told.append((k, int(not bad), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.kept, tuple(r.rejected_by)) for r in quality.judge(docs, labels_of(spark, told)).collect()}
    shares, base = {}, {}
    for k, text, _ in rows:
        s = dict(zip(quality.STAT_NAMES, quality.text_stats(text), strict=True))
        over = lambda a, b: s[a] / s[b] if s[b] else 0.0
        shares[k] = {"symbols": over("n_symbols", "word_chars"), "repeated_lines": over("n_dup_lines", "n_lines"),
                     "repeated_words": over("n_repeat_words", "n_words"), "capitals": over("n_upper", "word_chars"), "marks": over("n_marks", "word_chars")}
        base[k] = s["n_words"] < 20 or 100 * s["n_repeat_words"] > 30 * s["n_words"]
    stratum = {k: lang if lang in quality.STRATA else "other" for k, _, lang in rows}
    cutoffs, closed = {}, set()
    for _ in range(26):
        level = quality.DELTA / (25 - len(closed))
        for st in set(stratum.values()):
            good = [k for k, q, _ in told if q and not base[k] and stratum[k] == st]
            bad = [k for k, q, _ in told if not q and not base[k] and stratum[k] == st]
            for rule in shares[0]:
                passed = []
                for c in reversed(quality.GRID):
                    lost = sum(shares[k][rule] > c for k in good)
                    if quality.binomial_cdf(lost, len(good), quality.RISK / 5) > level:
                        break
                    passed.append((c, lost, sum(shares[k][rule] > c for k in bad)))
                useful = [c for c, lost, hit in passed if hit > lost]
                if useful:
                    cutoffs[st, rule] = min(useful)
                if len(passed) == len(quality.GRID):
                    closed.add((st, rule))
    assert cutoffs and {st for st, _ in cutoffs} >= {"en"}
    for k, _, _ in rows:
        fired = tuple(r for r in shares[k] if (stratum[k], r) in cutoffs and shares[k][r] > cutoffs[stratum[k], r])
        assert got[k] == (not base[k] and not fired, fired)


# ---- 8 ----

def test_base_spans_match_plain_patterns():
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
             "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    rng = random.Random(3)
    for k in range(4000):
        text = "".join(rng.choice("ab1290.@+- (é" if k % 2 else "4111 0.+-") for _ in range(rng.randrange(60)))
        found = []
        for kind, pattern in plain.items():
            for m in re.finditer(pattern, text):
                d = re.sub("[^0-9]", "", m[0])
                if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                        or kind == "card" and 12 <= len(d) <= 19 and pii.luhn(d) or kind == "phone" and 9 <= len(d) <= 15):
                    found.append((m.start(), m.end(), kind))
        assert pii.base_spans(text) == sorted(found, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_field_learns_other_formats():
    weights = pii.train([], rounds=25)
    found = lambda t: [(t[a:b], k) for a, b, k in pii.all_spans(t, weights)[1]]
    assert found("call me |(415) 555-0199| now".replace("|", "")) == [("(415) 555-0199", "phone")]
    assert found("token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" here") == [("04dbebab91ab85687d33eeaaf9ac699e1188f962", "secret")]
    assert found("License, Version 2.0. of 2004 and page 12") == [] and found("") == []


PIECES = ["12", "415", "555-0134", "(415)", "+1", "a@b.com", "x.y@z.org", "@", "key", "=", ":", "tel", "1.2.3.4", "v1.2", "1.2.3", "4111 1111 1111 1111", "10.20.300.1", "..",
          "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b", "abc_DEF12345678901", "\n", " ", " ", ".", ",", "é5", "2021", "--", "//", '("', "--a1b2c3d4e5f6g7h8", "١٢", "²3", "e-mail", "(", ")", "\t", "|", "["]


def plain_features(text: str, spans: list[tuple[int, int]], i: int, j: int) -> list[int]:
    """The active whole-span features, one by one, of the segment of tokens ``i`` to ``j`` (exclusive)."""
    a, b = spans[i][0], spans[j - 1][1]
    s = text[a:b]
    digits = pii._digits(s)
    n = len(digits)
    size = sum(n >= c for c in pii._COUNTS) - 1
    octets = re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", s) is not None and all(int(p) <= 255 for p in s.split("."))
    letters = sum(c.isalpha() for c in s)
    plain = all(c in "0123456789 ()-./+" for c in s)
    groups = re.findall(r"[0-9]+", s)
    balanced = s.count("(") == s.count(")")
    wordish = re.fullmatch(r"[A-Za-z0-9_/+-]{16,}", s) is not None
    before = [text[x:y].lower() for x, y in spans[max(0, i - 4):i]]
    on = [
        True, n == 0, "@" in s, re.fullmatch(r"[\w.%+-]+@[\w-]+(\.[\w-]+)+", s) is not None,
        s.count("@") == 1 and "." in s[s.index("@"):] and letters > 4,
        octets, plain and 12 <= n <= 19 and pii.luhn(digits), plain and 13 <= n <= 19 and s[0] not in "+(" and not pii.luhn(digits),
        s.startswith("+") and 9 <= n <= 15 and plain and balanced, s.startswith("(") and 9 <= n <= 15 and plain and balanced,
        plain and 9 <= n <= 12 and len(groups) >= 3 and balanced and "." not in s, plain and 9 <= n <= 15 and any(w in pii.CUES["phone"] for w in before),
        wordish and 0 < n < len(s) and letters > 3 and not re.search(r"[/-]{2}", s), wordish and re.fullmatch(r"[0-9a-f]{24,}", s) is not None and letters > 0,
        re.fullmatch(r"(19|20)[0-9]{2}", s) is not None, re.fullmatch(r"v?[0-9]+(\.[0-9]+){1,2}", s) is not None, plain and n <= 6,
        s[0] in ".,;:-)" or s[-1] in ".,;:-(+", j - i == 1, j - i > 6, a > 0 and text[a - 1] not in " \n\t\"'(=:<|[", b < len(text) and text[b:b + 1].isalnum(),
        any(w in ("=", ":") for w in before[-2:]), letters > 0 and plain is False and n > 0 and not wordish and "@" not in s,
    ]
    out = [k for k, x in enumerate(on) if x] + [len(on) + size]
    for k, kind in enumerate(pii.KINDS):
        if any(w in pii.CUES[kind] for w in before):
            out.append(len(on) + len(pii._COUNTS) + k)
    return out


def test_segment_features_match_plain_code():
    rng = random.Random(8)
    for _ in range(600):
        text = "".join(rng.choice(PIECES) + rng.choice((" ", "")) for _ in range(rng.randrange(1, 22)))
        spans = pii.tokens(text)
        if not spans:
            continue
        got = {(a, b): np.flatnonzero(f).tolist() for a, b, f in zip(*pii.cells(text, np.array(spans, np.int64)), strict=True)}
        want = {(a, b): sorted(plain_features(text, spans, a, b)) for a in range(len(spans)) for b in range(a + 1, min(len(spans), a + pii.MAX_SEGMENT) + 1)
                if re.search("[0-9@]", text[spans[a][0]:spans[b - 1][1]]) and "\n" not in text[spans[a][0]:spans[b - 1][1]]}
        assert got == want


def test_segmentation_is_the_best_of_all(monkeypatch):
    weights = pii.train([], rounds=25)
    rng = random.Random(9)

    def value(text, spans, chosen):
        return sum(weights[plain_features(text, spans, a, b), k].sum() for a, b, k in chosen)

    def every(text, spans, at):  # all segmentations from token ``at`` on, each segment with its best kind
        if at == len(spans):
            yield []
            return
        yield from every(text, spans, at + 1)
        for b in range(at + 1, min(len(spans), at + pii.MAX_SEGMENT) + 1):
            s = text[spans[at][0]:spans[b - 1][1]]
            if re.search("[0-9@]", s) and "\n" not in s:
                kind = int(weights[plain_features(text, spans, at, b)].sum(axis=0).argmax())
                yield from ([(at, b, kind), *rest] for rest in every(text, spans, b))

    some = 0
    for _ in range(60):
        text = " ".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 6)))
        spans = pii.tokens(text)
        if len(spans) > 8:
            continue
        starts, ends = {a: k for k, (a, _) in enumerate(spans)}, {b: k + 1 for k, (_, b) in enumerate(spans)}
        found = pii.segment(text, weights)
        some += len(found)
        mine = value(text, spans, [(starts[a], ends[b], pii.KINDS.index(kind)) for a, b, kind in found])
        assert math.isclose(mine, max(value(text, spans, c) for c in every(text, spans, 0)), abs_tol=1e-9)
    assert some > 5
    # blocks of any size give the same segments
    text = " ".join(rng.choice(PIECES) for _ in range(900))
    whole = pii.segment(text, weights)
    for size in (1, 2, 7):
        monkeypatch.setattr(pii, "BLOCK_TOKENS", size)
        assert pii.segment(text, weights) == whole


def test_long_numeric_text_in_bounded_memory():
    rng = random.Random(10)
    text = " ".join(str(rng.randrange(10 ** rng.randrange(1, 5))) for _ in range(290_000)) + " write to ann@example.com or call (415) 555-0134 now"
    weights = pii.train([], rounds=25)
    start = time.perf_counter()
    base, spans = pii.all_spans(text, weights)
    assert time.perf_counter() - start < 60  # seconds; some 2 here
    assert len(text) > 950_000 and base[-1][2] == "email" and (text[spans[-1][0]:spans[-1][1]], spans[-1][2]) == ("(415) 555-0134", "phone")
    tracemalloc.start()
    try:
        pii.all_spans(text, weights)
        assert tracemalloc.get_traced_memory()[1] < 200e6
    finally:
        tracemalloc.stop()
    lines = "\n".join(f"{k} and {k}" for k in range(20_000))
    assert list(pii.islands(lines)) == [(m.start(), m[0]) for m in re.finditer("[^\n]+", lines)]


# ---- 9 ----

def spelled(mined):
    """The mined rules with every token that may stand for a name: ``(tokens, rule)``."""
    members = collections.defaultdict(list)
    for r in mined.names.collect():
        members[r.name].append(r.token)
    return [(c, r) for r in mined.rules.collect() for c in itertools.product(*(members[x] for x in r.names))]


def test_listed_and_mined_rules(spark):
    hosts = [("a.net", "/x"), ("example.net", "/en/1"), ("b.example.com", "/de/2"), ("c.org", "/fr/3"), ("c.org", "/en/3"), ("b.example.com", "/en/7?k=1#t"), ("net", "")]
    pages = [(k, f"https://{h.upper()}{p}") for k, (h, p) in enumerate(hosts * 12)] + [(900, None), (901, "no address"), (902, "http://"), (900, None)]
    df = spark.createDataFrame(pages, "page_id long, url string").withColumn("token", F.lit("clash"))
    rows = urls.parsed(df)
    kept = [(set(t), r) for t, r in spelled(urls.mine(urls.labelled(rows, labels_of(spark, LABELS))))]
    tokened = {r.url: (set(r.t), r) for r in rows.select("url", "rule", "host", urls.tokens(F.col("url"), F.col("host"), F.col("path")).alias("t")).collect()}
    judged = urls.judge(df, labels_of(spark, LABELS)).collect()
    assert len(judged) == len(pages)
    by_id = dict(pages)
    for r in judged:
        if r.rule is None and r.host:
            fits = [(x.confidence, x.support, x.verdict) for t, x in kept if t <= tokened[by_id[r.page_id]][0]]
            assert r.verdict == (max(fits)[2] if fits else "allow")
    first = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged}
    assert first[0] == ("a.net", "/x", "net/", "block") and first[1] == ("example.net", "/en/1", "example.net/en/", "allow")
    assert first[2][2:] == ("example.com/de/", "block") and first[3][2:] == ("org/fr/", "allow") and first[5][1] == "/en/7" and first[6][:3] == ("net", "", None)
    assert first[900] == first[901] == ("", "", None, "allow") == first[902]


def test_small_hosts_get_rules_whatever_the_other_pages(spark):
    # 6 of 1,206 labelled pages: under 1 %, all blocked, with a long path in common
    deep = "/" + "/".join(f"part{chr(97 + k)}" for k in range(22))
    rows = [(k, f"https://bulk{k % 3}.example.com/a/{k}", 1) for k in range(1200)]
    rows += [(2000 + k, f"https://spam-farm.test{deep}/{k}", 0) for k in range(6)]
    new = [(5000, "https://spam-farm.test/other"), (5001, "https://elsewhere.example.com/a/3"), (5002, "https://x.test/b/partv")]
    df = spark.createDataFrame([(i, u) for i, u, _ in rows] + new, "page_id long, url string")
    told = labels_of(spark, [(i, q, 0) for i, _, q in rows])
    judged = {r.page_id: r.verdict for r in urls.judge(df, told).collect()}
    assert judged[5000] == judged[5002] == "block" and judged[5001] == judged[0] == "allow" and judged[2000] == "block"
    # rules by counting: every set of at most 2 tokens of a small table
    few = [(k, f"https://h{k % 4}.site{k % 3}.org/{'xy'[k % 2]}?q{k % 5}=1") for k in range(90)]
    small = urls.parsed(spark.createDataFrame(few, "page_id long, url string"))
    items = urls.labelled(small, labels_of(spark, [(k, int(k % 4 != 1 or k % 7 == 0), 0) for k, _ in few]))
    sets = [frozenset(r["items"]) for r in items.collect()]
    want = {}
    for size in (1, 2):
        for c in {c for x in sets for c in itertools.combinations(sorted(t for t in x if t[0] != "="), size)}:
            met = [x for x in sets if x >= set(c)]
            for v in ("block", "allow"):
                hit = sum("=" + v in x for x in met)
                if hit >= 1 and hit / len(met) >= urls.MIN_CONFIDENCE:
                    want[c, v] = (hit / len(met), hit / len(sets))
    kept = {k: v for k, v in want.items() if not any(want.get(((t,), k[1]), (0,))[0] >= v[0] for t in k[0] if len(k[0]) > 1)}
    got = {(tuple(sorted(t)), r.verdict): (r.confidence, r.support) for t, r in spelled(urls.mine(items, min_rows=1, max_tokens=2))}
    assert got.keys() == kept.keys() and all(np.allclose(got[k], kept[k]) for k in kept)


def test_rules_are_not_multiplied_by_tokens_that_come_together(spark):
    one, other = ("/".join(f"{x}{chr(97 + k)}" for k in range(20)) for x in ("left", "right"))
    paths = [f"{one}/{other}", one, other, "plain"]
    rows = [(k, f"https://h.test/{paths[k % 4]}?p{k % 7}") for k in range(160)]
    told = labels_of(spark, [(k, int(k % 4 != 0), 0) for k, _ in rows])
    parsed = urls.parsed(spark.createDataFrame(rows, "page_id long, url string"))
    rules = [r for r in urls.mine(urls.labelled(parsed, told)).rules.collect() if r.verdict == "block"]
    assert 1 <= len(rules) <= 3 and min(len(r.names) for r in rules) == 2
    new = [(900, "https://h.test/leftd/rightq"), (901, "https://h.test/leftd/x"), (902, "https://h.test/rightq/x")]
    every = spark.createDataFrame(rows + new, "page_id long, url string")
    judged = {r.page_id: r.verdict for r in urls.judge(every, told).collect()}
    assert judged[900] == "block" and judged[901] == judged[902] == "allow"
    assert all(judged[k] == ("block" if k % 4 == 0 else "allow") for k, _ in rows)


def test_support_is_a_number_of_pages_at_every_size(spark):
    rows = [(k, f"https://host{k}.test/a{k}") for k in range(40)] + [(50 + k, f"https://bad.site/{k}") for k in range(4)]
    parsed = urls.parsed(spark.createDataFrame(rows, "page_id long, url string"))
    told = labels_of(spark, [(k, int(k < 50), 0) for k, _ in rows])
    mined = spelled(urls.mine(urls.labelled(parsed, told)))
    assert {r.verdict for _, r in mined} == {"allow"} and all(r.support >= 5 / 44 for _, r in mined)


# ---- 10 ----

def test_folding_and_exceptions():
    m = toxicity.Matcher({"clown$": 3.0, "idio": 2.0}, {"clown fish"})
    assert m.hits(toxicity.folded_words("Hi cl0wn, IDI0T$$$ сlоwn clowns")) == [(1, 3.0), (2, 2.0), (3, 3.0)]
    assert m.strength("a clown fish") == 0 == m.strength("") == m.strength(None) and m.strength("a clown") > 0


def test_substitutes_at_word_edges_are_folded():
    m = toxicity.Matcher({"idio": 2.0, "stupid": 4.0, "trash$": 3.0, "scums$": 5.0, "clown$": 3.0}, {"trash can"})
    hits = lambda t: m.hits(toxicity.folded_words(t))
    assert hits("an 1diot, 5tupid 7rash 1d107!") == [(1, 2.0), (2, 4.0), (3, 3.0), (4, 2.0)]
    assert hits("$cum5 5cum$ scum5 $cum$$$") == [(0, 5.0), (1, 5.0), (2, 5.0)]
    assert hits("@clown clown5 clown$$$ 2clown 9clown9") == [(k, 3.0) for k in range(5)]
    assert hits("1010 555 $$$ 7.5 4 455 @@ 291diot") == [] and toxicity.folded_words("1010 555 $$$ @$") == [""]
    assert m.strength("the 7rash can") == 0 < m.strength("the 7rash bin")
    # learned too, and the number of words stays
    assert "stupid$" in toxicity.terms_of(toxicity.folded_words("a 5tupid").every()) and len(toxicity.folded_words("a 5tupid5")) == 2
    assert toxicity.folded_words("1" * 200_000 + " $" * 200_000) == [""]


def test_toxicity_learns_from_training_rows_only(spark):
    rng = random.Random(4)
    rows, told = [], []
    for k in range(400):
        words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnrst')}" for _ in range(60)]
        if k % 4 == 0:
            words[7] = words[31] = "vile" + rng.choice(["ness", "st", "r"])
        rows.append((k, " ".join(words)))
        told.append((k, 1, int(k % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, labels_of(spark, told))
    got = toxicity.score(docs, model).collect()
    assert all((r.score >= 0.3) == (r.doc_id % 4 == 0) for r in got if r.held_out)
    flipped = [(i, q, 1 - t if binascii.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in told]
    assert toxicity.fit(docs, labels_of(spark, flipped)) == model


# ---- the pipeline ----

@pytest.mark.skipif(not os.path.exists("/root/repo/corpus_pipeline.py"), reason="pipeline not present")
def test_pipeline(spark):
    import corpus_pipeline
    docs = common.table(spark, SF, "documents")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = kept
        kept = common.stored(stage(spark, kept, SF), name)
        assert kept.columns == docs.columns and kept.count() <= before.count()
    left = kept.collect()
    assert len({r.doc_id for r in left}) == len(left) and not any(pii.base_spans(r.text) for r in left)
    assert decontaminate.leaks(kept, common.table(spark, SF, "benchmark")).count() == 0
    assert all(r.n_links == 0 and r.n_copies == 1 for r in near_duplicates.join(kept).where("class_key IS NOT NULL").collect())
    mixed = corpus_pipeline.STAGES[4][1](spark, kept, SF)
    assert 0 < mixed.count() < len(left) and corpus_pipeline.run(spark, SF).count() == mixed.count()

"""Hard negatives, line runs and spelling variants against brute force."""

import binascii
import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimsflow.llm import chat, common, decontaminate, hard_negatives, line_runs, mixing, toxicity, variants

EMB = "vec_id long, embedding array<float>, label int, slot int, score string, rank int"


@pytest.mark.parametrize("shape", [(1, 1, 1), (17, 33, 40), (64, 64, 64), (63, 50, 129), (5, 100, 3)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(sum(shape))
    a = rng.integers(-2**20, 2**20, shape[:2])
    b = rng.integers(-2**20, 2**20, shape[1:])
    assert (hard_negatives.strassen(a, b, leaf=4) == a @ b).all()


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(0)
    owner, score, ids = rng.integers(0, 7, 500), rng.integers(-5, 5, 500), rng.permutation(500)
    heaps = hard_negatives.Heaps(7, 5)
    for part in np.array_split(rng.permutation(500), 9):
        heaps.push(owner[part], score[part], ids[part])
    got = sorted(zip(*(x.tolist() for x in heaps.rows()), strict=True))
    best = [r for o in range(7) for r in sorted((o, -s, i) for p, s, i in zip(owner, score, ids, strict=True) if p == o)[:5]]
    assert got == sorted((int(o), int(-s), int(i)) for o, s, i in best)


def brute_negatives(rows):
    rows = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, [int(np.floor(256 * float(x))) for x in v]) for i, v, lab, *_ in rows
            if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, own, u in [r for r in rows if r[0] % 100 == 0]:
        scores = sorted((-sum(x * y for x, y in zip(u, v, strict=False)), i, lab) for i, lab, v in rows if i != a)
        for p, pid, _ in [s for s in scores if s[2] == own][:5]:
            window = [(s, i) for s, i, lab in scores if lab != own and 80 * -p <= 100 * -s <= 100 * -p][:5]
            out += [(a, pid, k, i, -p, -s) for k, (s, i) in enumerate(window, 1)]
    return sorted(out)


def test_hard_negatives_match_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    # Few values, so that scores tie often; all signs; some odd rows.
    rows = [(int(i), [float(x) for x in rng.choice([-0.5, 0.0, 0.25, 0.5], 7)], int(rng.integers(0, 3)), 1, "s", 2) for i in range(700)]
    rows += [(1000, None, 1, 1, "s", 2), (1100, [0.5] * 7, None, 1, "s", 2), (1101, [0.5, None] + [0.0] * 5, 1, 1, "s", 2), (None, [0.5] * 7, 1, 1, "s", 2),
             (1200, [float("nan")] * 7, 0, 1, "s", 2), (1201, [float("inf")] * 7, 0, 1, "s", 2), (1300, [0.5, 0.5], 1, 1, "s", 2), (1400, [], 1, 1, "s", 2)]
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 37)
    monkeypatch.setattr(hard_negatives, "ANCHOR_TILE_ROWS", 2)
    monkeypatch.setattr(hard_negatives, "BUFFER_ROWS", 100)
    monkeypatch.setattr(hard_negatives, "GROUP_BYTES", 150)  # several groups of anchors
    df = spark.createDataFrame(rows, EMB).repartition(3)
    got = sorted(tuple(r) for r in hard_negatives.mine(hard_negatives.of_embeddings(df)).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    assert got == brute_negatives(rows) and len(got) > 50


def test_hard_negatives_of_repeated_and_of_no_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.5], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.95, 0.0], 2), (2, [0.95, 0.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = hard_negatives.mine(hard_negatives.of_embeddings(df)).collect()
    # 7 divides 0: its label becomes 2, so 2 is its positive and 1 scores too high; no negative is left
    assert got == []
    got = hard_negatives.mine(df.select("vec_id", "label", F.col("embedding").alias("vector"))).collect()
    assert sorted((r.anchor_id, r.positive_id, r.negative_id, r.rank) for r in got) == []
    whole = df.select("vec_id", "label", F.transform("embedding", lambda x: F.rint(x * 100)).alias("vector"))
    got = hard_negatives.mine(whole).collect()
    # both rows of id 1 are positives, both of id 2 are negatives of each
    assert collections.Counter((r.anchor_id, r.positive_id, r.negative_id) for r in got) == {(0, 1, 2): 4} and {r.rank for r in got} == {1, 2}
    assert hard_negatives.mine(whole.limit(0)).count() == 0
    with pytest.raises(Exception, match="too large"):
        hard_negatives.mine(spark.createDataFrame([(0, 1, [1e30])], hard_negatives.ROWS)).collect()


def plain_dedup(texts, least):
    key = lambda s: re.sub(r"^[\x20\x09-\x0d]+|[\x20\x09-\x0d]+$", "", s).translate({k: k + 32 for k in range(65, 91)})
    lines = [(t or "").split("\n") for t in texts]
    n = collections.Counter(k for own in lines for k in {key(x) for x in own})
    return [(len(own), "\n".join(x for x in own if not key(x) or n[key(x)] < least)) for own in lines]


LINES = ["A line", " a LINE\t", "a line ", "Élan", "élan", "\x0bélan", "", "  ", "x", "\x85x", "other line", "ÄB", "äb"]


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (7, 2), (5, 3)])
def test_line_runs_match_plain_code(spark, batches, fanout):
    rng = random.Random(batches)
    texts = ["\n".join(rng.choice(LINES + [f"only {k}", f"some {k % 9}"]) for _ in range(rng.randint(0, 12))) for k in range(120)]
    texts += [None, "", "\n", "x\n" * 5000] + ["Same text\nin full"] * 3
    ids = [None if k % 11 == 0 else k % 100 for k in range(len(texts))]
    rows = [(i, t, "k", 1, 2, "x") for i, t in zip(ids, texts, strict=True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_lines int, h1 int, `_gone` string").repartition(4)
    out = line_runs.drop_frequent(docs, min_docs=4, batches=batches, fanout=fanout)
    got = collections.Counter((r.doc_id, r.text, r.n_lines, r.n_dropped, r.kept) for r in out.collect())
    want = collections.Counter((i, t, n, n - (len(k.split("\n")) if k or n == 1 else 0), k) for i, t, (n, k) in
                               zip(ids, texts, plain_dedup(texts, 4), strict=True))
    # a text whose lines all go, and one whose only line left is empty, look alike in plain code
    strip = lambda c: collections.Counter({(i, t, n, k): v for (i, t, n, _, k), v in c.items()})
    assert strip(got) == strip(want) and {"h1", "_gone"} <= set(out.columns)
    assert all(n - d == len(k.split("\n")) for _, _, n, d, k in got if k)
    assert line_runs.drop_frequent(docs.limit(0)).count() == 0


def test_runs_are_levelled_and_compacted(spark):
    runs = line_runs.LineRuns(spark, min_docs=3, fanout=2, buckets=4)
    for k in range(7):
        runs.add(spark.createDataFrame([(1, 1), (k, 2)] + [(9, 9)] * (k < 2), "h1 long, h2 long"))
        assert sum(2**level * len(run) for level, run in enumerate(runs.levels)) == k + 1
        assert all(len(run) < 2 for run in runs.levels)
    held = {(r.h1, r.h2): r.n for t in runs.tables() for r in spark.table(t).collect()}
    # what a run knew as frequent was not written again
    assert sum(r.n for t in runs.tables() for r in spark.table(t).where("h1 = 1 AND h2 = 1").collect()) < 7 and (9, 9) in held
    plan = runs._summed(runs.tables()[:2])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    names = runs.tables()
    assert [(r.h1, r.h2) for r in runs.frequent().collect()] == [(1, 1)]
    assert not any(spark.catalog.tableExists(t) for t in names)


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_variants(rows, least, count, ratio, divisor):
    n = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({k: k + 32 for k in range(65, 91)})
            h = binascii.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % divisor == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= least and c >= count}
    mates = {w: sorted((v for v in n if near(w, v)), key=lambda v: (-n[v], v)) for w in n}
    form = {w: m[0] for w, m in mates.items() if m and n[m[0]] >= ratio * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, form.get(w, ""), root(w), n[w], len(mates[w]), n.get(form.get(w), 0)) for w in n), mates


@pytest.mark.parametrize("long", [64, 4])
def test_variants_match_brute_force(spark, monkeypatch, long):
    monkeypatch.setattr(variants, "LONG", long)
    rng = random.Random(5)
    # Runs of equal letters, accents, edits at both ends; counts spread so that forms chain.
    words = sorted({"".join(rng.choice("aabÀé") for _ in range(rng.randint(3, 6))) for _ in range(150)})
    rows = [(k % 40 if k % 7 else None, " ".join(rng.choices(words, [3.0 ** (hash_of(w) % 8) for w in words], k=200)) + " 1x_Ab") for k in range(80)]
    rows += [(1, None), (2, ""), (3, "aaaa aaaa aaaa" * 3), (3, "aaaa aaaa aaaa" * 3)]
    docs = spark.createDataFrame([(*r, "w", 1, "k") for r in rows], "doc_id long, text string, word string, n int, form string")
    want, mates = plain_variants(rows, 3, 2, 3, 5)
    got = variants.variants(docs, min_length=3, min_count=2, ratio=3, typos=5).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in got) == want
    assert any(w[1] and w[2] != w[1] for w in want)  # a chain of forms
    names = variants.named(variants.words(docs, 3, 2, 5))
    full = {(r.w.word, r.w.id): r.word for r in names.collect()}
    pairs = variants.neighbours(names, pairs=True).collect()
    assert sorted((full[tuple(r.w)], full[tuple(r.near)]) for r in pairs) == sorted((w, v) for w, m in mates.items() for v in m)
    assert variants.variants(docs.limit(0)).count() == 0


def hash_of(word):
    return hashlib.md5(word.encode()).digest()[0]


def test_long_texts_and_words(spark):
    long = "ab" * 20_000
    docs = spark.createDataFrame([(k, f"{long} {long}c " + "word\n" * 20_000) for k in range(12)], "doc_id long, text string")
    got = {(len(r.word), r.n, r.n_near, r.form) for r in variants.variants(docs, typos=None).collect()}
    assert got == {(40_000, 12, 1, None), (40_001, 12, 1, None)}
    out = line_runs.drop_frequent(docs).collect()
    # the first line and "word" are in all twelve; the empty last line stays
    assert {(r.n_lines, r.n_dropped, r.kept) for r in out} == {(20_001, 20_000, "")}


def test_new_queries_read_whole_tables(spark):
    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    assert line_runs.op12_line_dedup(spark, "/root/testdata/sf0.001").count() == docs.count()


# ---- toxicity against plain code ----

def plain_strength(words, lexicon, exceptions):
    total = 0.0
    for k, w in enumerate(words):
        weight = max((x for t, x in lexicon.items() if (w == t[:-1] if t.endswith("$") else w.startswith(t))), default=0.0)
        mates = {f"{words[k - 1]} {w}" if k else "", f"{w} {words[k + 1]}" if k + 1 < len(words) else ""}
        total += 0.0 if mates & exceptions else weight
    return total / len(words)**0.5 if words else 0.0


def test_toxicity_matches_plain_code(spark):
    rng = random.Random(8)
    plain = [f"{a}{b}{c}{d}" for a in "bcdf" for b in "aeiou" for c in "lmn" for d in ("", "er", "ing")]
    rows, told = [], []
    for k in range(600):
        words = [rng.choice(plain) for _ in range(rng.randint(0, 40))]
        toxic = k % 5 == 0
        if toxic:
            words[3:3] = rng.choice([["vileness", "vilest"], ["grumbo"], ["zapp", "zapper"]])
        elif k % 35 == 1:
            words += ["grumbo", "garden"]
        rows.append((k, " ".join(words) if words or k % 2 else None))
        told.append((k, 1, int(toxic)))
    told += [(k, 1, 1) for k in range(1, 20, 5)] + [(9000, 1, 1), (None, 1, 1), (17, 1, None)]  # contradicting, unknown
    docs = spark.createDataFrame([(*r, 1, "b", "t") for r in rows], "doc_id long, text string, label int, `_block` string, term string")
    labels = spark.createDataFrame(told, "doc_id long, quality int, toxic int")
    said = collections.defaultdict(set)
    for i, _, t in told:
        if i is not None and t is not None:
            said[i].add(t)
    train = [(t, min(said[i])) for i, t in rows if len(said[i]) == 1 and binascii.crc32(str(i).encode()) % 4 != 2]
    got = toxicity.labelled(docs, labels).collect()
    assert sorted((r.text or "", r.label) for r in got) == sorted((t or "", y) for t, y in train)
    per_doc = collections.Counter()
    for t, y in train:
        per_doc.update({(x, y) for w in set((t or "").split()) for x in (w + "$", *(w[:k] for k in range(3, 9) if k <= len(w)))})
    toxic, clean = sum(y for _, y in train), sum(1 - y for _, y in train)
    terms = sorted({x for x, _ in per_doc})
    odds = {x: np.log((per_doc[x, 1] + 0.5) / (toxic + 1)) - np.log((per_doc[x, 0] + 0.5) / (clean + 1)) for x in terms}
    model = toxicity.fit(docs, labels)
    lexicon = model["lexicon"]
    assert lexicon and all(abs(odds[x] - v) < 1e-9 and v >= toxicity.MIN_LOG_ODDS and per_doc[x, 1] >= toxicity.MIN_SUPPORT for x, v in lexicon.items())
    # every telling term is in it, or a shorter or longer one that says the same
    told_by = lambda x: any(x[:-1].startswith(t.rstrip("$")) or t.startswith(x.rstrip("$")) for t in lexicon)
    assert all(told_by(x) for x in terms if odds[x] >= toxicity.MIN_LOG_ODDS and per_doc[x, 1] >= toxicity.MIN_SUPPORT)
    assert "grumbo garden" in model["exceptions"]
    a, b = model["curve"]
    out = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    for i, t in rows:
        s = plain_strength((t or "").split(), lexicon, set(model["exceptions"]))
        assert abs(out[i] - 1 / (1 + np.exp(-np.clip(a + b * s, -30, 30)))) < 1e-9


def test_labelled_rows_are_cut_before_the_shuffle(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    ids = spark.range(0, 20_000, 40).select(F.col("id").alias("doc_id"))
    left = {r.doc_id for r in toxicity.cut_to(docs, ids, 500).collect()}
    assert left >= set(range(0, 20_000, 40)) and len(left) < 2500
    assert toxicity.cut_to(docs, ids.limit(0), 0).count() == 0


# ---- decontamination, chat and mixing on ordinary input ----

def test_recased_copies_and_short_items_are_found(spark):
    item = "If Anna has 12 apples and Bob has 7 apples, how many apples do Anna and Bob have together?"
    bench = spark.createDataFrame([(1, item), (2, "What is 7 plus"), (3, "Yes"), (4, "7"), (5, "!?")], "item_id long, text string")
    rows = [(1, f"So. {item} Well."), (2, f"so. {item.lower()} well."), (3, f"SO. {item.upper()} WELL."), (4, "Tell me: what is 7 plus 5?"),
            (5, "Tell me: what is 8 plus 5?"), (6, "Yes"), (7, "Yes, of course, at 7"), (8, " 7! "), (9, "8"), (10, f"So. {item.title()}"),
            (11, item.lower().replace("12", "30")), (12, "The cat sat on the mat and looked at the moon for 12 hours"), (13, None), (14, "?!")]
    got = {(r.doc_id, r.item_id): r.verbatim for r in decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 1), (10, 1), (11, 1), (4, 2), (6, 3), (8, 4)}
    assert not got[11, 1] and got[1, 1] and got[2, 1]
    left = decontaminate.clean(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert {r.doc_id for r in left} == {5, 7, 9, 12, 13, 14}


def test_turns_are_numbered_before_they_are_cut(spark):
    rows = [(1, 300 * k, ("ann", "bob")[k % 2], f"t{k}") for k in range(6)] + [(2, None, "cy", f"n{k:03}") for k in range(300)]
    rows += [(3, 10**15 + 7 * k, ("ann", "bob", "system")[k % 3], f"u{k}") for k in range(520)]
    said = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    out = chat.rotate(said).collect()
    assert [(r.part, r.place, r.n_turns) for r in out if r.conv_id == 1] == [(0, 0, 6)] * 2
    assert sorted((r.part, r.place, r.n_turns) for r in out if r.conv_id == 2) == [(0, 0, 256), (1, 256, 44)]
    for who in ("ann", "bob"):
        own = sorted((r for r in out if r.conv_id == 3 and r.perspective == who), key=lambda r: r.part)
        assert [(r.place, r.n_turns) for r in own] == [(0, 256), (256, 256), (512, 8)]
        assert re.findall(r"u\d+", "".join(r.rendered for r in own)) == [f"u{k}" for k in range(520)]
    whole = {(r.conv_id, r.perspective): r for r in chat.rotate(said, part_turns=None).collect()}
    assert len(whole) == 5 and whole[3, "ann"].n_turns == 520 and whole[2, "cy"].rendered.count("<|assistant|>") == 300
    r = whole[3, "bob"]
    assert [r.rendered[m.start:m.end] for m in r.mask] == [f"u{k}<|end|>\n" for k in range(1, 520, 3)]


def test_sources_of_one_language_each_have_a_defined_mix(spark, tmp_path):
    rows = [(k, "word " * (20 + k), ("en", "de", "fr")[k % 3], f"s{k % 3}", 1) for k in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, margin_error int").write.parquet(f"{tmp_path}/documents.parquet")
    out = mixing.op1_source_mix(spark, str(tmp_path)).collect()
    assert len(out) == 60 and {r.margin_error for r in out} == {0.0}  # here both margins ask for the same
    rows += [(100 + k, "word " * 900, "de", "s0", 1) for k in range(5)] + [(200, "word " * 50, "es", "s9", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, margin_error int")
    docs.where("lang <> 'en' OR source <> 's0'").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    out = mixing.op1_source_mix(spark, str(tmp_path)).collect()
    assert len(out) == 46 and len({r.margin_error for r in out}) == 1 and out[0].margin_error > 0.01
    assert all(0 <= r.probability <= 1 and r.weight >= 0 for r in out)

"""Each operator against a plain version, on a fixture of awkward rows and on whole tables; empty tables; determinism."""

import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import brute
from cellrisk.llm import bpe, catalog, common, hamming, jaccard, language, lattice, mixing, secrets, suffixes, tokens, toxicity
from cellrisk.llm.components import components
from cellrisk.session import scratch_path

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def sha(data):
    return hashlib.sha256(data).hexdigest()


def counted(frame, *columns):
    return collections.Counter(map(tuple, frame.select(*columns).collect()))


@pytest.fixture(scope="module")
def whole(spark, sf_dir):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


# 1: exact top-k search


def nearest(codes, queries, k):
    out = set()
    for q, c in queries:
        found = sorted((bin((c ^ d) & (2**64 - 1)).count("1"), i) for i, d in codes if i != q)[:k]
        out |= {(q, r + 1, i, d) for r, (d, i) in enumerate(found)}
    return out


def test_topk_ties_repeats_and_nulls(spark):
    rng = np.random.default_rng(1)
    codes = [(i, int(c)) for i, c in enumerate(rng.integers(-(2**63), 2**63, 300))]
    codes += [(1000 + i, codes[7][1]) for i in range(40)] + [(2000 + i, codes[7][1] ^ (1 << i)) for i in range(40)]
    df = spark.createDataFrame([*codes, (5000, None), (None, 5)], "id long, code long")
    got = hamming.nearest_codes(df, df.where("id % 100 = 0"), 10)
    assert set(map(tuple, got.collect())) == nearest(codes, [c for c in codes if c[0] % 100 == 0], 10)


def test_topk_short_and_empty(spark):
    df = spark.createDataFrame([(0, 1), (1, 2)], "id long, code long")
    assert list(map(tuple, hamming.nearest_codes(df, df, 10).orderBy("query_id").collect())) == [(0, 1, 1, 2), (1, 1, 0, 2)]
    assert hamming.nearest_codes(df.where("false"), df.where("false")).count() == 0


# 2: language ID


def test_language_of_awkward_texts(docs, none):
    got = {r["doc_id"]: r for r in language.identify(docs).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (4, 5, 6, 14))
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert language.identify(docs).count() == docs.count()
    assert language.identify(none).count() == 0
    assert language.accepted(docs).columns == docs.columns


def test_language_accuracy_on_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = language.identify(docs, ("doc_id", "lang")).where("held_out and lang is not null and lang_pred != 'und'").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.9


# 3: suffix dedup


def digest_rows(df):
    return sorted((r[0], len(bytes(r[1])), r[2], r[3]) for r in df.selectExpr("n_bytes", "kept", "n_bytes - octet_length(kept)", "size(removed)").collect())


def test_repeats_of_awkward_texts(docs, none, rows):
    got = suffixes.without_repeats(docs).collect()
    want = collections.Counter((d, *x) for (d, *_), x in zip(rows, brute.repeats([r[1] for r in rows])) if d != 10)
    mine = collections.Counter((r[0], r[1], r[1] - len(r[2]), len(r[3]), sha(bytes(r[2]))) for r in got if r[0] != 10)
    assert mine == want
    assert suffixes.without_repeats(none).count() == 0


def test_repeats_of_random_overlaps(spark):
    rng = np.random.default_rng(3)
    base = "".join(rng.choice(list("abcdef"), 6000))
    texts = [base[a : a + n] for a, n in zip(rng.integers(0, 5000, 60), rng.integers(300, 1500, 60))]
    texts += [base[:700] + "#" + base[250:900], "z" * 399, "y" * 400, "w" * 401, "q" * 400, "é" * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r[0]: (r[1], r[1] - len(r[2]), len(r[3]), sha(bytes(r[2]))) for r in suffixes.without_repeats(df).collect()}
    assert [got[i] for i in range(len(texts))] == brute.repeats(texts)


# 4: n-gram Jaccard join


def test_groups_of_awkward_texts(docs, none, rows):
    got = counted(jaccard.near_groups(docs), "doc_id", "n_shingles", "component_id")
    assert got == collections.Counter(brute.near_groups([(r[0], r[1]) for r in rows]))
    assert jaccard.near_groups(none).count() == 0


def test_groups_of_chained_copies(spark):
    rng = np.random.default_rng(4)
    text, rows = [f"w{i}" for i in range(60)], []
    for i in range(300):
        if rng.random() < 0.4:
            text = list(text)
            text[rng.integers(60)] = f"v{rng.integers(10**6)}"
        rows.append((i, " ".join(text[: 60 - rng.integers(4)])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert counted(jaccard.near_groups(df), "doc_id", "n_shingles", "component_id") == collections.Counter(brute.near_groups(rows))


def test_a_large_group_is_not_compared_in_full(spark, monkeypatch):
    """Copies with one, two or no words of 100 changed: those with two are similar only to those with none."""
    base, draw, texts = [f"w{i}" for i in range(100)], np.random.default_rng(5), []
    for i in range(1200):
        words = list(base)
        for at in draw.choice(100, size=draw.choice(3, p=[0.3, 0.3, 0.4]), replace=False):
            words[at] = f"x{i}y{at}"
        texts.append((i, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    measured, pairs = jaccard._measured, []
    monkeypatch.setattr(jaccard, "_measured", lambda p, *rest: pairs.append(p.count()) or measured(p, *rest))
    got = {r["component_id"] for r in jaccard.near_groups(docs).collect()}
    assert got == {0}
    assert sum(pairs) < 100 * len(texts)


def test_groups_of_all_documents(spark, sf_dir, whole):
    got = counted(catalog.op4_ngram_jaccard(spark, sf_dir), "doc_id", "n_shingles", "component_id")
    assert got == collections.Counter(brute.near_groups(whole))


def test_parity_bits_differ_no_more_than_sets():
    rng = np.random.default_rng(3)
    for size, other in ((1, 1), (5, 300), (700, 690), (4000, 3000)):
        pool = rng.integers(0, 1 << 63, size=size + other, dtype=np.uint64)
        one, two = np.unique(pool[:size]), np.unique(pool[size // 2 : size // 2 + other])
        bits = np.bitwise_count((jaccard.parity(one) ^ jaccard.parity(two)).view(np.uint64)).sum()
        assert bits <= len(np.setxor1d(one, two))
        assert not (jaccard.parity(one) ^ jaccard.parity(one[::-1])).any()


def test_folded_parity_keeps_similar_sets(spark):
    """Sets of one share of common shingles, on both sides of a step in the number of bits: none that may link is ruled out."""
    rng = np.random.default_rng(5)
    rows, pairs = [], []
    for i, (n, m, common) in enumerate([(1000, 1100, 950), (1000, 1040, 1000), (60, 66, 60), (3, 3, 3), (2000, 2100, 0), (5, 300, 5)]):
        pool = rng.integers(0, 1 << 63, size=n + m - common, dtype=np.uint64)
        for rid, found in ((2 * i, pool[:n]), (2 * i + 1, pool[n - common :])):
            rows.append((rid, len(found), jaccard.parity(np.sort(found), jaccard.parity_bits(len(found))).tolist()))
        pairs.append((2 * i, 2 * i + 1))
    reps, asked = spark.createDataFrame(rows, "rid long, n int, parity array<long>"), spark.createDataFrame(pairs, "a long, b long")
    assert {r["a"] // 2 for r in jaccard._within(asked, reps, jaccard.SIMILAR).collect()} == {0, 1, 2, 3}


def test_one_of_each_group_stays(docs, none):
    kept = [r["doc_id"] for r in jaccard.without_copies(docs).select("doc_id").collect()]
    assert kept.count(9) == 1 and 2 not in kept and 1 in kept and {4, 5, 6} <= set(kept)
    assert jaccard.without_copies(none).count() == 0


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 499), (7, 7), (None, 3)], "a long, b long")
    got = dict(map(tuple, components(links).collect()))
    assert got == {**{i: 0 for i in range(201)}, 499: 499, 500: 499}


# 5: secret scans


def told(found):
    return ",".join(f"{k}:{b}:{e}" for b, e, k in found)


def test_base_secrets_of_all_documents(spark, sf_dir, whole):
    got = {r["doc_id"]: r for r in catalog.op5_secret_scan(spark, sf_dir).collect()}
    assert len(got) == len(whole)
    for d, text in whole:
        base = brute.base_spans(text)
        assert got[d]["base_sha256"] == sha(told(base).encode())
        assert (got[d]["n_assign"], got[d]["n_access"], got[d]["n_hex"]) == tuple(sum(s[2] == k for s in base) for k in ("assign", "access", "hex"))
        assert set(told(base).split(",")) - {""} <= set(got[d]["spans"].split(","))


def test_secrets_of_awkward_texts(docs, none):
    got = {r["doc_id"]: r for r in secrets.report(secrets.scan(docs)).collect()}
    assert all(got[i]["base_sha256"] == EMPTY_SHA and got[i]["spans"] == "" for i in (4, 5, 6))
    assert (got[12]["n_assign"], got[12]["n_access"], got[12]["n_hex"]) == (1, 1, 1)
    assert secrets.scan(none).count() == 0


def test_novelty_tells_random_strings_from_identifiers(spark):
    text = "the bearer value qX7v2Lm9Zt4Rk8Wp3Ny6 is private; credential request_handler_1_request_handler_1 follows request_handler_1"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = secrets.scan(df).first()["found"]
    assert [text[s["begin"] : s["end"]] for s in found if s["kind"] == "novel"] == ["qX7v2Lm9Zt4Rk8Wp3Ny6"]


@pytest.mark.parametrize("gap", [1, 49, 50, 63, 64])
def test_candidates_reach_both_ways(gap):
    string = "Zk3Vq9Lw2Xc8Rt5Yb7Nm"
    for after in ("password" + " " * gap + string + " end", "secret token" + " " * gap + string):
        assert [after[a:b] for a, b in secrets.candidates(after)] == [string]
    before = "start " + string + " " * gap + "password"
    assert [before[a:b] for a, b in secrets.candidates(before)] == [string]
    assert secrets.candidates("password" + " " * 65 + string) == secrets.candidates(string + " " * 65 + "password") == []


def test_redaction_keeps_rows_and_columns(docs):
    out = secrets.redacted(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    clean = out.where("doc_id = 12").first()
    assert "sk_live" not in clean["text"] and "AKIA" not in clean["text"] and clean["n_chars"] == len(clean["text"])


# 6: toxicity


def test_toxic_documents_are_told(spark, sf_dir):
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").collect()}
    got = catalog.op6_toxicity(spark, sf_dir).collect()
    assert all(0 <= r["severity"] <= 2 for r in got)
    known = [(bool(labels[r["doc_id"]]), r["toxic"]) for r in got if labels.get(r["doc_id"]) is not None]
    assert np.mean([a == b for a, b in known]) > 0.9


def test_toxicity_of_awkward_texts(spark, docs, none):
    labels = spark.createDataFrame([(1, 0), (9, 0), (12, 1), (None, 1), (13, None)], "doc_id long, toxic int")
    assert toxicity.grade_texts(docs, toxicity.severity_model(docs, labels)).count() == docs.count()
    assert toxicity.grade_texts(docs, toxicity.severity_model(docs, labels.where("false"))).where("toxic").count() == 0
    assert toxicity.grade_texts(none, toxicity.severity_model(none, labels)).count() == 0


@pytest.mark.parametrize("words, passed", [(1 << 20, 2200), (1, 9001)])
def test_narrowed_rows_hold_all_that_are_asked_for(spark, monkeypatch, words, passed):
    monkeypatch.setattr(common, "MARKS", words)
    none = spark.sql("select cast(null as bigint)")
    ids = spark.range(0, 3000, 3).union(none).toDF("i")
    rows = spark.range(9000).toDF("_word").union(none).selectExpr("_word", "_word as _bits")
    got = common.narrowed(rows, "_word", ids, "i", 1001)
    assert got.columns == rows.columns
    assert got.count() <= passed
    assert got.join(ids, F.col("_word").eqNullSafe(F.col("i"))).count() == 1001


def test_texts_without_a_label_are_not_shuffled(spark, monkeypatch):
    docs = spark.range(4000).selectExpr("id as doc_id", "concat('word ', id % 3) as text")
    labels = spark.range(0, 4000, 400).selectExpr("id as doc_id", "cast(id % 800 = 0 as int) as toxic")
    kept, met = toxicity.narrowed, []
    monkeypatch.setattr(toxicity, "narrowed", lambda *args: met.append(kept(*args)) or met[-1])
    toxicity.severity_model(docs, labels)
    assert 10 <= met[0].count() < 1000


def test_shared_weights_recover_ordered_grades():
    rng = np.random.default_rng(6)
    n = [rng.integers(0, 6, 1).astype(float) for _ in range(600)]
    grade = np.array([0 if x[0] < 2 else 1 if x[0] < 4 else 2 for x in n])
    weights, thresholds = toxicity.fit_ordinal([np.array([0])] * 600, n, grade, 1, 3)
    p = toxicity.grade_probabilities(np.log1p(np.concatenate(n)) * weights[0], thresholds)
    assert thresholds[0] < thresholds[1] and (p.argmax(axis=1) == grade).mean() > 0.98


# 7: mixing


def test_mix_of_awkward_rows(docs, none, rows):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and mixing.mix(none).count() == 0
    sizes = collections.Counter()
    for _, text, _, source in rows:
        sizes[source] += len(brute.word_list(text))
    goal = brute.targets(sizes)
    assert all(r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(goal[r["source"]]) and 0 <= r["taken"] <= 3 * r["size"] for r in got)


def test_sources_without_words_take_their_weight(spark):
    rows = [(1, None, "a"), (2, "w " * 100, "b"), (3, "w " * 100, "c")]
    got = {r["source"]: r["target"] for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got == {"a": 0.0, "b": pytest.approx(400 / 3), "c": pytest.approx(200 / 3)}


def test_mix_comes_near_targets_and_agrees_with_itself(spark, sf_dir):
    one, two = (catalog.op7_source_mix(spark, sf_dir).toPandas().sort_values("doc_id", ignore_index=True) for _ in range(2))
    assert one.equals(two)
    sums = one.groupby("source", dropna=False).agg(taken=("taken", "sum"), target=("target", "first"))
    assert (abs(sums.taken - sums.target) <= 0.02 * sums.target + 5).all()


def test_small_sources_beside_a_hot_one_come_near_their_targets(spark):
    small = {f"s{i:03d}": 1 + i % 9 for i in range(60)}
    rows = [(i, "w " * 20000, "hot") for i in range(60)] + [(1000 + i, "w " * n, s) for i, (s, n) in enumerate(small.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for slots in (64, 1 << 17):
        taken = collections.Counter()
        for r in mixing.mix(docs, slots=slots).collect():
            taken[r["source"]] += r["taken"]
        want = brute.targets({"hot": 1200000, **small})
        assert all(taken[s] == round(want[s]) for s in small)
        assert abs(taken["hot"] - want["hot"]) <= 2 * 1200300 / slots + len(small) * 3
    assert {r["source"] for r in mixing.repeated(docs).select("source").distinct().collect()} == {"hot", *small}


def test_repeated_rows_keep_columns(docs):
    out = mixing.repeated(docs)
    assert out.columns == docs.columns and out.where("doc_id in (4, 5, 6)").count() == 3


# 8: byte-level BPE


@pytest.fixture(scope="module")
def coder():
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(VOCABULARY), special_tokens={})


def test_bpe_of_all_documents(spark, sf_dir, whole, coder):
    got = {r["doc_id"]: r for r in catalog.op8_byte_bpe(spark, sf_dir).collect()}
    assert len(got) == len(whole)
    for d, text in whole:
        ids = coder.encode_ordinary(text or "")
        assert got[d]["n_tokens"] == len(ids)
        assert got[d]["ids_sha256"] == sha(",".join(map(str, ids)).encode())
        assert got[d]["decoded_sha256"] == sha((text or "").encode())


def test_bpe_of_awkward_texts(docs, none, rows, coder):
    got = sorted(bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN, ("doc_id", "n")).collect(), key=str)
    want = collections.Counter((r[0], "x", tuple(coder.encode_ordinary(r[1] or ""))) for r in rows)
    assert collections.Counter((r[0], r[1], tuple(r[2])) for r in got) == want
    back = bpe.decode(bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN), VOCABULARY)
    assert collections.Counter((r[0], bytes(r[1])) for r in back.collect()) == collections.Counter((r[0], (r[1] or "").encode()) for r in rows)
    assert bpe.encode(none, VOCABULARY, public_tokenizers.PATTERN).count() == 0


def test_bpe_appends_and_edits_agree_with_coding_at_once(coder):
    tables = bpe.merge_tables(bpe.read_ranks(VOCABULARY))
    rng, letters = np.random.default_rng(8), list("etaoin ")
    for _ in range(50):
        piece = "".join(rng.choice(letters, 40)).encode()
        growing = bpe.Prefixes(tables)
        for k in range(0, 40, 7):
            growing.append(piece[k : k + 7])
        at = bpe.Prefixes(tables)
        at.append(piece)
        assert growing.ids() == at.ids() == coder._core_bpe.encode_single_piece(piece)
        begin = int(rng.integers(35))
        growing.replace(begin, begin + 4, b"qz")
        assert growing.ids() == coder._core_bpe.encode_single_piece(piece[:begin] + b"qz" + piece[begin + 4 :])


# 9: embedding near-dedup


def near_vectors(rows):
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = np.array([np.array(rows[i][1]) / np.linalg.norm(rows[i][1]) for i in ok])
    one, two = np.nonzero(np.triu(unit @ unit.T >= 0.9, 1))
    return {(rows[ok[a]][0], rows[ok[b]][0]) for a, b in zip(one, two)}


def test_vectors_recall_and_no_false_link(spark, sf_dir):
    rows = list(map(tuple, spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()))
    links = near_vectors(rows)
    want = collections.Counter(x for pair in links for x in pair)
    got = {r["vec_id"]: r for r in catalog.op9_embedding_neardup(spark, sf_dir).collect()}
    assert len(got) == len(rows) and all(got[i]["n_links"] <= want[i] for i in got)
    assert sum(r["n_links"] for r in got.values()) >= 0.9 * sum(want.values())
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_awkward_vectors(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(60, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(100 + i, (v + 0.05 * rng.normal(size=16)).tolist()) for i, v in enumerate(base)]
    rows += [(200, rows[0][1]), (201, rows[0][1]), (300, None), (301, [0.0] * 16), (302, [float("nan")] * 16), (303, [None] * 16), (304, []), (305, [float("inf")] + [1.0] * 15)]
    tiny, huge = [1e-200 * x for x in rows[1][1]], [1e200 * x for x in rows[1][1]]
    rows += [(202, tiny), (203, huge)]
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], "vec_id long, embedding array<double>, rid string, weight string")
    got = {r["vec_id"]: r for r in lattice.near_vectors(df).collect()}
    alike = [(i, [x * 1e200 for x in v] if v is tiny else [x * 1e-200 for x in v] if v is huge else v) for i, v in rows]
    want = collections.Counter(x for pair in near_vectors(alike) for x in pair)
    assert got[202]["component_id"] == got[203]["component_id"] == 1
    assert len(got) == len(rows) and all(got[i]["n_links"] == 0 and got[i]["component_id"] == i for i in range(300, 306))
    assert sum(r["n_links"] for r in got.values()) >= 0.9 * sum(want.values()) and got[201]["component_id"] == 0
    assert lattice.near_vectors(df.where("false")).count() == 0


@pytest.mark.parametrize("count", [10**4, 10**6, 10**7, 10**8, 10**9])
def test_planned_tables_keep_the_recall_at_any_count(count):
    scale, tables = lattice.plan(count, 64, 0.9, 0.97)
    rng = np.random.default_rng(11)
    a, b = rng.normal(size=(2, 20000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(1 - 0.9**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    chances = []
    for table in range(4):
        x, y = lattice.cells(a, table, scale, 3), lattice.cells(b, table, scale, 3)
        chances.append(((x == y[:, :1]).any(axis=1) | (y == x[:, :1]).any(axis=1)).mean())
    assert 1 - (1 - np.mean(chances)) ** tables >= 0.95
    assert tables * (lattice.BLOCK + count * lattice.share_chance(scale, 64)) < 3e5


def test_decoding_finds_the_nearest_lattice_point():
    y = np.random.default_rng(10).normal(size=(500, 8)) * 3
    point = lattice.nearest_e8(y)
    own = ((y - point / 2) ** 2).sum(axis=1)
    for step in lattice.shortest_vectors():
        assert (((y - (point + step) / 2) ** 2).sum(axis=1) >= own - 1e-9).all()


# 10: token counts


def test_token_counts_of_all_documents(spark, sf_dir, whole):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("flat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = counted(catalog.op10_token_counts(spark, sf_dir), "doc_id", "n_tokens")
    assert got == collections.Counter((d, len(plain.encode_ordinary(t or ""))) for d, t in whole)


def test_separators_across_blocks_and_files(spark, tmp_path, monkeypatch):
    data = np.array([5, 0, 0, 7, 7, 7, 0, 1, 2, 3, 4, 5, 6, 0, 9], dtype="<u2")
    for i, (a, b) in enumerate([(0, 4), (4, 4), (4, 9), (9, 15)]):
        (tmp_path / f"part-00000-{i}").write_bytes(data[a:b].tobytes())
    (tmp_path / "part-00001-0").write_bytes(b"")
    got = sorted(map(tuple, tokens.document_tokens(spark, str(tmp_path), separator=0).collect()))
    assert got == [("00000", i, b, n, c) for i, (b, n, c) in enumerate([(0, 1, True), (2, 0, True), (3, 3, True), (7, 6, True), (14, 1, False)])]


def test_token_counts_of_an_empty_table(spark, none):
    path = scratch_path(spark, "none")
    none.select("doc_id", "text").write.parquet(path)
    kept = spark.read.schema("doc_id long, text string").parquet(path)
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert tokens.counted(kept, scratch_path(spark, "flat"), vocabulary, public_tokenizers.PATTERN, 50256).count() == 0

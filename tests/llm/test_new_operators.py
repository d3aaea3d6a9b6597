"""Fill-in-middle, chunked BPE and token alignment against plain versions."""

import collections
import hashlib
import os
import random
import re

import numpy as np
import public_tokenizers
import pytest
import regex
import sentencepiece
from tokenizers import Tokenizer

from cellrisk.llm import align, catalog, chunks, infill

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
TOKENIZER, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = [*"ab \n1!'<>", "é", "漢", "  ", "'ll", "<P", "<P>", "\U0001f600", "\x0b", " ", "<|endoftext|>", "<|endof", "\U0010fffd", "ֈ", "\r\n", "▁"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def mixed_texts(count, longest, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(longest))) for _ in range(count)]
    return [*texts, *(p * 300 for p in PARTS), None, "", " "]


# 11: fill in middle

TOKEN = regex.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_infill(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(x in text for x in infill.MARKS) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_infill_of_awkward_rows(docs, none, rows):
    moved = infill.fill_in_middle(docs)
    assert collections.Counter(map(tuple, moved.collect())) == collections.Counter(plain_infill(r[0], r[1]) for r in rows)
    back = infill.restore(infill.fill_in_middle(docs, keep=("doc_id", "n_chars", "id")), keep=("doc_id", "id"))
    assert collections.Counter(map(tuple, back.collect())) == collections.Counter((r[0], "x", r[1] or "") for r in rows)
    assert infill.fill_in_middle(none).count() == 0 and infill.restore(infill.fill_in_middle(none)).count() == 0


@pytest.mark.parametrize("block", [5, 1 << 20])
def test_displacements_of_random_texts(monkeypatch, block):
    monkeypatch.setattr(infill, "BLOCK", block)
    texts = mixed_texts(1500, 30, 11)
    ids = list(range(len(texts)))
    out, bounds, n, form, p, m = infill.scattered(texts, ids, infill.MARKS, 42, 50, 80)
    outputs = infill.strings(out, bounds).to_pylist()
    for i, text in enumerate(texts):
        counted = (int(p[i]), int(m[i])) if form[i] else (None, None)
        assert (i, n[i], infill.FORMS[form[i]], *counted, outputs[i]) == plain_infill(i, text)
    assert {0, 1, 2} == set(form.tolist())
    back, bounds = infill.gathered(outputs, [infill.FORMS[f] for f in form], infill.MARKS)
    assert infill.strings(back, bounds).to_pylist() == [t or "" for t in texts]


def test_infill_of_all_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = {r[0]: plain_infill(*r) for r in docs}
    got = catalog.op11_fill_in_middle(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r, text in zip(sorted(got), sorted(docs)):
        assert tuple(r[:5]) == want[r["doc_id"]][:5] and r["output_sha256"] == sha(want[r["doc_id"]][5]) and r["restored_sha256"] == sha(text[1] or "")


@pytest.mark.parametrize("marks", [("a", "a", "b"), ("", "b", "c"), ("aba", "x", "y"), ("<a", "a>", "c"), ("abc", "b", "d")])
def test_marks_that_could_not_be_found_again_are_refused(marks):
    with pytest.raises(ValueError):
        infill._checked(marks)


def test_outputs_without_their_marks_are_refused():
    with pytest.raises(ValueError):
        infill.gathered(["<P>a<S>b"], ["psm"], infill.MARKS)


# 12: chunked BPE


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


@pytest.mark.parametrize("least, mean, most", [(1, 4, 16), (4, 16, 64), (64, 512, 8192)])
def test_chunk_joins_agree_with_coding_at_once(monkeypatch, library, least, mean, most):
    for name, value in (("LEAST", least), ("MEAN", mean), ("MOST", most), ("CHUNKS", 50), ("PIECES", 40)):
        monkeypatch.setattr(chunks, name, value)
    coder, literal = chunks.Coder(chunks.specification(TOKENIZER)), chunks.Coder(chunks.specification(TOKENIZER, special=False))
    plain = Tokenizer.from_file(TOKENIZER)
    plain.encode_special_tokens = True
    for text in mixed_texts(400, 400, 12):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert coder.encode(text) == want and literal.encode(text) == plain.encode(text or "", add_special_tokens=False).ids
        assert coder.decode(want) == library.decode(want, skip_special_tokens=False)


def test_cuts_follow_the_content():
    rng = np.random.default_rng(12)
    passage = "".join(rng.choice(list("abcdefgh é漢"), 20000))
    one, two = passage.encode(), ("x" * 777 + passage).encode()
    first, second = chunks.cuts(one), [c - 777 for c in chunks.cuts(two)]
    assert len(set(first) & set(second)) > 0.9 * len(first)
    assert all(b - a <= chunks.MOST for a, b in zip(first, first[1:]))
    for c in first:
        one[:c].decode()
    assert chunks.cuts(b"") == [0] and chunks.cuts(b"a" * 20000) == [0, 8192, 16384, 20000]


def test_shared_chunks_are_encoded_once(monkeypatch):
    coder = chunks.Coder(chunks.specification(TOKENIZER))
    rng = random.Random(13)
    passage = " ".join(str(rng.randrange(10**6)) for _ in range(3000))
    coder.encode("one " + passage)
    had, seen = len(coder.known), []
    monkeypatch.setattr(coder, "pieces_of", lambda text, own=coder.pieces_of: seen.append(len(text)) or own(text))
    coder.encode("another beginning, " + passage)
    assert len(coder.known) - had <= 4 and sum(seen) < 0.4 * len(passage)


def test_classes_of_settled_characters_agree_with_the_library(library):
    coder = chunks.Coder(chunks.specification(TOKENIZER))
    settled = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and not coder.unsettled(chr(c))]
    assert len(settled) > 90_000
    for i in range(0, len(settled), 4096):
        text = "".join(f"a{c}1!" for c in settled[i : i + 4096])
        ends = [b for _, (_, b) in library.pre_tokenizer.pre_tokenize_str(text)]
        assert np.cumsum(list(map(len, coder.matches(text)))).tolist() == ends


def test_chunked_bpe_of_awkward_rows(docs, none, rows, library):
    want = collections.Counter((r[0], "x", tuple(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    coded = chunks.encode(docs, TOKENIZER, ("doc_id", "id"))
    assert collections.Counter((r[0], r[1], tuple(r[2])) for r in coded.collect()) == want
    back = chunks.decode(chunks.encode(docs, TOKENIZER), TOKENIZER)
    assert collections.Counter(map(tuple, back.collect())) == collections.Counter((r[0], r[1] or "") for r in rows)
    assert chunks.encode(none, TOKENIZER).count() == 0 and chunks.digests(none, TOKENIZER).count() == 0


def test_chunked_bpe_of_all_documents(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in catalog.op12_chunked_bpe(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for d, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert (got[d]["n_tokens"], got[d]["ids_sha256"]) == (len(ids), sha(",".join(map(str, ids))))
        assert got[d]["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))


def test_other_tokenizers_are_refused(tmp_path):
    with pytest.raises(ValueError):
        chunks.specification(public_tokenizers.path("word_bpe_49k.json"))


# 13: cross-tokenizer alignment


def plain_alignment(rows, library, pieces):
    """Rows (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) by looking at the two tokens of each byte."""
    byte = chunks.byte_of()
    name = {i: t for t, i in library.get_vocab().items()}
    found, totals = [], collections.Counter()
    for doc_id, text in rows:
        a = library.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        bytes_a = [bytes(byte[c] for c in name[i]) for i in a]
        told = [pieces.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, told)]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            found.append((doc_id, [], [], [], []))
            continue
        owner_a, owner_b = ([i for i, x in enumerate(t) for _ in x] for t in (bytes_a, bytes_b))  # of each byte
        pairs = list(dict.fromkeys(zip(owner_a, owner_b)))
        links = [(a[i], b[k]) for i, k in pairs]
        groups, had_a, had_b = [], [], []
        for at, (i, k) in enumerate(pairs):
            had_a, had_b = dict.fromkeys([*had_a, i]), dict.fromkeys([*had_b, k])
            if at + 1 == len(pairs) or (pairs[at + 1][0] != i and pairs[at + 1][1] != k):
                groups.append(",".join(str(a[x]) for x in had_a) + "|" + ",".join(str(b[x]) for x in had_b))
                had_a, had_b = [], []
        totals.update(links)
        found.append((doc_id, a, b, groups, links))
    most = collections.Counter()
    for (_, y), n in totals.items():
        most[y] = max(most[y], n)
    out = []
    for doc_id, a, b, groups, links in found:
        best = sum(totals[x] == most[x[1]] for x in links)
        out.append((doc_id, len(a), len(b), len(groups), len(links), best, sum(totals[x] for x in links), sha(";".join(groups)) if a else ""))
    return out


@pytest.fixture(scope="module")
def both():
    plain = Tokenizer.from_file(TOKENIZER)
    plain.encode_special_tokens = True
    return plain, sentencepiece.SentencePieceProcessor(model_file=MODEL)


FIGURES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_of_awkward_rows(docs, none, rows, both):
    short = [(r[0], r[1]) for r in rows if r[0] != 10]
    got = align.digests(docs.where("doc_id is null or doc_id != 10"), TOKENIZER, MODEL).select(*FIGURES)
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(plain_alignment(short, *both))
    assert align.digests(none, TOKENIZER, MODEL).count() == 0 and align.align(none, TOKENIZER, MODEL).count() == 0
    assert align.digests(docs, TOKENIZER, MODEL, ("n", "doc_id", "size")).count() == len(rows)


@pytest.mark.parametrize("block", [1, 3000, 8 << 20])
def test_alignment_in_blocks_of_any_size(spark, monkeypatch, both, block):
    monkeypatch.setattr(align, "BLOCK", block)
    rows = list(enumerate(mixed_texts(150, 60, 14)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = align.digests(df, TOKENIZER, MODEL).select(*FIGURES)
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(plain_alignment(rows, *both))


def test_blocks_end_before_a_task_holds_much_text(spark):
    df = spark.range(60).selectExpr("id as doc_id", "repeat('alpha beta ', 10000) as text").coalesce(1)
    blocks = align._blocks(df, TOKENIZER, MODEL, ["doc_id"], "text")
    assert blocks.selectExpr("size(texts) as n").agg({"n": "max"}).first()[0] <= 20


def test_slices_join_to_the_ids(docs, rows, both):
    for r in align.align(docs, TOKENIZER, MODEL).collect():
        assert (r["a_cuts"][-1:], r["b_cuts"][-1:]) == ([len(r["a_ids"])] if r["a_ids"] else [], [len(r["b_ids"])] if r["b_ids"] else [])
        assert r["a_cuts"] == sorted(set(r["a_cuts"])) and len(r["a_cuts"]) == len(r["b_cuts"])


def test_alignment_of_all_documents(spark, sf_dir, both):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = catalog.op13_token_alignment(spark, sf_dir).select(*FIGURES)
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(plain_alignment(docs, *both))


def test_words_are_aligned_once(both):
    coder = chunks.Coder(chunks.specification(TOKENIZER, special=False))
    with open(MODEL, "rb") as file:
        words = align.Words(coder, align.PieceCoder(file.read()))
    plain, coded = coder.plain, []
    coder.plain = lambda text: coded.append(text) or plain(text)
    words.of(["alpha beta alpha", "beta  gamma\n  alpha ", None, ""])
    found, some = words.of(["alpha beta", "gamma\n delta"])
    assert coded == [" alpha", " beta", "  gamma\n  alpha", " ", " gamma\n delta"]
    assert [x.tolist() for x in some] == [[0, 1], [2]] and len(found) == 3


def test_words_split_only_where_both_tokenizers_do(both):
    spaces = [c for c in map(chr, range(0x110000)) if regex.match(r"\s", c)]
    assert all(re.match(r"\s", c) for c in spaces)
    coder = chunks.Coder(chunks.specification(TOKENIZER, special=False))
    with open(MODEL, "rb") as file:
        words = align.Words(coder, align.PieceCoder(file.read()))
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "\t ", " ", "　 ", "'s", "don't", "12", "漢字", "é", "!!", "ab", "A b", "\x1c", "ﬁ", "\U0001f600", "<unk>", "▁"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 14))) for _ in range(1500)]
    found, some = words.of(texts)
    for text, mine in zip(texts, some):
        a, b = align.both_ids(text, coder, words.pieces)
        want = align.aligned([(a, b)], coder.sizes, words.pieces.sizes)[0]
        got = [found[i] for i in mine]
        assert tuple(map(sum, zip(*(x[:3] for x in got)))) == want[:3] or not got and not a
        assert b"".join(x[3] for x in got) == want[3] and b"".join(x[4] for x in got) == want[4]


def test_new_words_are_coded_together_and_no_pieces_are_kept(both):
    coder = chunks.Coder(chunks.specification(TOKENIZER, special=False))
    with open(MODEL, "rb") as file:
        words = align.Words(coder, align.PieceCoder(file.read()))
    texts = [
        "plain words, all of them new;", "tail of a text\n", "two  spaces \n  and a line\n\n", "   ", " ", "don't we'll  'tis", "größe naïve — 東京 ok",
        "<|endoftext|> and <s> as text", "tab\tand other   spaces", "x" * 300 + " long", "a͸b \U0001fae8 late", "1234 5 6,7.8",
    ]
    asked = []
    plain = coder.plain
    coder.plain = lambda text: asked.append(text) or plain(text)
    found, some = words.of(texts)
    fresh = chunks.Coder(chunks.specification(TOKENIZER, special=False))
    for text, of in zip(texts, some):
        a, b = align.both_ids(text, fresh, words.pieces)
        want = align.aligned([(a, b)], fresh.sizes, words.pieces.sizes)[0] if a else align.NOTHING
        entries = [found[i] for i in of.tolist()]
        assert tuple(sum(e[k] for e in entries) for k in range(3)) == want[:3], text
        assert tuple(b"".join(e[k] for e in entries) for k in (3, 4)) == want[3:], text
    # What a worker remembers are words; ten thousand more of them add nothing to the pieces, and one odd word sends few of them one by one.
    asked.clear()
    words.of([" ".join(f"word{i:x}q" for i in range(10_000))])
    assert not asked and len(coder.pieces) < 100 and len(words.known) > 10_000
    words.of([" ".join(f"more{i:x}q" for i in range(2_000)) + " \ufb01n"])
    assert len(asked) <= 2 * align.FEW

"""Each operator against a plain version: over the smallest tables, and over odd rows made here."""

from __future__ import annotations

import collections
import hashlib
import itertools
import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quotewell.llm import bytepairs, chat, fingerprints, graph, language, ngram_join, packing, personal, quality, queries, secret_scan, warc, words
from quotewell.session import shared_dir

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
WORD = re.compile("[^\x20\x09-\x0D]+")
ODD = [
    (None, "a b c d e f g"), (3, None), (3, None), (4, "x y"), (5, "X y"), (None, None), (7, "a b c d e f g"), (9, " "), (10, ""),
    (11, "mail me: jo@ex.org now\nmail me: jo@ex.org now\n"), (12, "naïve Ünïcode 字   \x0b end"), (13, "1 2 3"), (14, "w " * 9000),
]


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty texts, repeated rows, a long text, and columns named like those the operators make."""
    df = spark.createDataFrame(ODD, "doc_id bigint, text string")
    names = ["kept", "found", "blob", "mark", "n", "spans", "score", "rep", "digest", "row"]
    return df.withColumns({c: F.lit("own") for c in names})


def run(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


# ---- words ----------------------------------------------------------------------------------------


def test_words_and_shingles_are_those_of_the_pattern():
    rng = random.Random(5)
    sample = ["".join(rng.choice(["a", "B", " ", "\n", "é", "字", "\x0b", "foo "]) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    w = words.Words(*words.from_texts(sample), fold=True)
    assert w.counts.tolist() == [len(WORD.findall(t)) for t in sample]
    plain = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for t in sample for x in WORD.findall(t)]
    by_word = dict(zip(plain, w.hash.tolist()))
    assert [by_word[p] for p in plain] == w.hash.tolist() and len(set(by_word.values())) == len(by_word)
    hashes, bounds = w.shingles(3)
    seen, at = {}, 0
    for n, a, b in zip(w.counts, bounds, bounds[1:]):
        own = plain[at : at + n]
        at += n
        grams = [tuple(own[i : i + 3]) for i in range(max(1, n - 2))] if n else []
        assert len(grams) == b - a
        for g, h in zip(grams, hashes[a:b].tolist()):
            assert seen.setdefault(g, h) == h
    assert len(set(seen.values())) == len(seen)


# ---- 1 personal data ------------------------------------------------------------------------------

BASE_PII = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain_pii(text):
    out = []
    for kind, pattern in enumerate(BASE_PII):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2 and not (12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_entities_on_adversarial_texts():
    rng = random.Random(3)
    parts = ["a", "b.c", "@", "@x.y", ".", "-", "_", " ", "+1", "(383) 555", "1.2.3.4", "256.1.1.1", "4111111111111111", "4 1-1 ", "0", "99", "é", "\n", "00001.2.3.4"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert personal.base_spans(text) == plain_pii(text), text


def test_op1_over_the_table(spark, texts):
    rows = run(spark, "op1_personal_data")
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain_pii(texts[r.doc_id])
        line = ",".join(f"{personal.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert r.base_sha256 == sha(line)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in spans) for i in range(4)]
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))


def test_patterns_find_identifiers_the_base_does_not(spark):
    rows = [(i, f"please call support line +1 555 010 {1000 + i} or write") for i in range(12)]
    rows += [(100, "please call support line 555-010-7777 today"), (101, "the chapter number 555-010-8888 today")]
    rows += [(200 + i, f"the chapter number 12-34-56{i:02d} and so on") for i in range(8)]
    found = personal.extracted(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = {r.doc_id: [(s.kind, s.start) for s in r.spans] for r in found.collect()}
    assert got[100] == [("context_phone", 25)] and got[101] == []
    assert all(got[i] == [("phone", 25)] for i in range(12))


def test_op1_odd_rows(spark, odd):
    got = collections.Counter((r.doc_id, r.n_email) for r in personal.digest(personal.extracted(odd)).collect())
    assert got == collections.Counter((k, 2 if k == 11 else 0) for k, _ in ODD)
    assert personal.digest(personal.extracted(odd.limit(0))).count() == 0


# ---- 2 language -----------------------------------------------------------------------------------


def test_op2_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = run(spark, "op2_language")
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.rejected for r in rows) <= 0.02 * len(rows)


def test_op2_odd_rows_and_rejection(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.learn(docs.filter(~language.held_out()))
    got = [(r.doc_id, r.lang_pred, r.rejected) for r in language.predicted(odd, model).collect()]
    assert len(got) == len(ODD)
    none = [(k, t) for k, t in ODD if not re.search(r"[^\W\d_]", t or "")]
    assert sum(p == "und" and x for _, p, x in got) == len(none)
    noise = spark.createDataFrame([(1, " ".join("qzxjkvw"[i % 7] * 3 + "ЖЩЪ" for i in range(200)))], "doc_id bigint, text string")
    assert language.predicted(noise, model).first().rejected
    assert language.accepted_rows(odd, model).columns == odd.columns
    empty = language.learn(docs.limit(0))
    assert {r.lang_pred for r in language.predicted(odd, empty).collect()} == {"und"}


def test_copies_do_not_thin_the_sample(spark):
    few = [(label, f"{label} text {i}") for label in ("aa", "bb") for i in range(5) for _ in range(400)]
    many = [("cc", f"cc text {i % 3000}") for i in range(9000)]
    docs = spark.createDataFrame(few + many, "lang string, text string")
    got = collections.Counter(r.label for r in language.sample(docs, "lang", "text", 20).collect())
    assert got == {"aa": 5, "bb": 5, "cc": 20}


def test_every_language_is_learned_and_held_back():
    def bag(label, i):
        return label, np.array([1000 * (ord(label) - 96) + j for j in range(i, i + 30)]), np.ones(30)

    # Read in the order of their marks, each fifth text is the only one of `b` or one of the two of `c`.
    bags = [bag("a", i) for i in range(20)]
    bags.insert(4, bag("b", 0))
    bags.insert(9, bag("c", 0))
    bags.insert(14, bag("c", 1))
    model = language.fit(bags)
    assert model.seen[2000] and model.seen[3000] and model.seen[3030]
    means = np.array([model.logits[:, b].mean(1) for _, b, _ in bags])
    best, _ = language.calibrated(means, model.temperature)
    assert [model.languages[i] for i in best] == [b[0] for b in bags]


def test_subwords_of_a_long_text_are_counted_over_slices(monkeypatch):
    data = np.frombuffer(b"the cat sat on the mat " * 50, np.uint8)
    whole = language.counted(data)
    monkeypatch.setattr(words, "SLICE_BYTES", 64)
    part = language.counted(data)
    assert (whole[0] == part[0]).all() and (whole[1] == part[1]).all()


# ---- 3 fingerprints -------------------------------------------------------------------------------


def plain_sketch(text):
    """The operator's own hash of each shingle, kept by a plain loop."""
    data, offsets = words.from_texts([text])
    hashes, _ = words.Words(data, offsets, fold=True).shingles(5)
    return {h for h in hashes.tolist() if h < 2**64 / 8}


def test_op3_over_the_table(spark, texts):
    got = {r.doc_id: r for r in run(spark, "op3_fingerprints")}
    order = sorted(texts, reverse=True)
    assert sorted(got) == order[::-1]
    for i, k in enumerate(order):
        own, after = texts[k] or "", texts[order[(i + 1) % len(order)]] or ""
        third = len(own) // 3
        edited = own[: len(own) - third] + after[:third]
        r = got[k]
        assert (r.n_chars, r.edited_sha256) == (len(own), sha(edited))
        a, b, c = plain_sketch(own), plain_sketch(edited), plain_sketch(after)
        assert {h % 2**64 for h in r.fingerprint} == a and {h % 2**64 for h in r.edited_fingerprint} == b
        for near, x, t in ((r.near_edited, b, edited), (r.near_next, c, after)):
            assert near == pytest.approx(len(a & x) / len(a | x) if a and x else float(not a and not x and own == t))


def test_op3_odd_rows_and_merging(spark, odd):
    rows = fingerprints.against_edits(odd).collect()
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(k for k, _ in ODD)
    assert fingerprints.against_edits(odd.limit(0)).count() == 0 and fingerprints.against_edits(odd.limit(1)).count() == 1
    prints = fingerprints.fingerprints(spark.read.parquet(f"{SF}/documents.parquet")).withColumn("one", F.lit(1))
    together = fingerprints.merged(prints, "one").count()
    assert together == prints.select(F.explode("fingerprint")).distinct().count()
    share = prints.select(fingerprints.containment(F.col("fingerprint"), F.col("fingerprint")).alias("x")).filter("x < 1")
    assert share.count() == 0


# ---- 4 n-gram join --------------------------------------------------------------------------------


def plain_groups(rows, k, num, den):
    sets = {}
    for key, text in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[key] = {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    group = {key: key for key in sets}
    keys = sorted(sets)
    for i, x in enumerate(keys):
        for y in keys[:i]:
            both = len(sets[x] & sets[y])
            if both and den * both >= num * len(sets[x] | sets[y]):
                a, b = sorted((group[x], group[y]))
                group = {key: a if g == b else g for key, g in group.items()}
    return {key: (len(sets[key]), group[key]) for key in keys}


@pytest.mark.parametrize("part", [1 << 19, 500])
def test_op4_over_the_table(spark, texts, monkeypatch, part):
    monkeypatch.setattr(ngram_join, "PART", part)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in run(spark, "op4_ngram_join")}
    assert got == plain_groups(texts.items(), 4, 85, 100)


def test_op4_many_near_copies_and_chains(spark, monkeypatch):
    """Groups of near copies just above and below the threshold, chains of them, and a line that all share."""
    monkeypatch.setattr(ngram_join, "PART", 300)
    rng = random.Random(11)
    rows = []
    for base in range(6):
        body = [f"w{base}x{rng.randrange(900)}" for _ in range(60)]
        for _ in range(14):
            body = list(body)
            for _ in range(rng.randint(0, 3)):
                body[rng.randrange(len(body))] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join([*body, "this very line is shared by all of them here"])))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for k, num in ((4, 85), (5, 80)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.groups(df, k=k, num=num).collect()}
        assert got == plain_groups(rows, k, num, 100)


def test_op4_rare_ngrams_meet_packed(spark):
    """Each n-gram that two classes have comes with all of them and the smallest; n-grams travel many to a row, not one."""
    rng = random.Random(3)
    sets = {rep: rng.sample(range(1 << 60, (1 << 60) + 4000), 50) + rng.sample(range(-900, -1), 20) for rep in range(-20, 100)}
    pack = lambda grams: np.array(grams, np.int64).tobytes()
    rows = [(rep, 70, pack(grams[10:]), pack(grams[:10])) for rep, grams in sets.items()]
    classes = spark.createDataFrame(rows, "rep bigint, n bigint, light binary, dense binary")
    plain = []
    for part in (slice(10, None), slice(10)):
        having = collections.defaultdict(list)
        for rep, grams in sets.items():
            for gram in grams[part]:
                having[gram].append(rep)
        plain += [(gram, rep, 70, min(reps)) for gram, reps in having.items() if len(reps) > 1 for rep in reps]
    for lights in (1, 5 * ngram_join.DEALT):
        met = ngram_join._shared(classes, lights)
        assert sorted(map(tuple, met.collect())) == sorted(plain)
        assert not re.search(r"Window|Generate", met._jdf.queryExecution().toString())


@pytest.mark.parametrize("few", [0, 3, 64])
def test_op4_ngrams_of_few_and_of_many_classes(spark, monkeypatch, few):
    """However many classes an n-gram may have to be counted by twos, classes that share enough are connected."""
    monkeypatch.setattr(ngram_join, "FEW", few)
    rng = random.Random(5)
    sets = {rep: rng.sample(range(400), 12) for rep in range(150)}
    having = collections.defaultdict(list)
    for rep, grams in sets.items():
        for gram in grams:
            having[gram].append(rep)
    met = [(gram, rep, 100, min(reps)) for gram, reps in having.items() if len(reps) > 1 for rep in reps]
    kin = ngram_join._kin(spark.createDataFrame(met, ngram_join._MET), 80, 100)
    got = {r.node: r.label for r in graph.components(kin).collect()}
    label = {rep: rep for rep in sets}
    for a, b in itertools.combinations(sets, 2):
        if len(set(sets[a]) & set(sets[b])) >= 3 and label[a] != label[b]:
            low, high = sorted((label[a], label[b]))
            label = {rep: low if x == high else x for rep, x in label.items()}
    assert {rep: got.get(rep, rep) for rep in sets} == label


def test_op4_small_blocks_link_as_large_ones():
    rng = random.Random(7)
    for turn in range(30):
        base = rng.sample(range(10_000), 40)
        sets = [np.array(sorted({*rng.sample(base, 36), *rng.sample(range(10_000), rng.randrange(6))}), np.uint64) for _ in range(12)]
        tree = ngram_join.Tree(sets)
        sets = [sets[i] for i in tree.order]
        start, found = np.array([i // 2 if turn % 2 else i for i in range(12)]), []
        for links in (tree.links, lambda *a: ngram_join._table_links(sets, *a)):
            groups = start.copy()
            pairs = links(np.arange(12 if turn % 3 else 5), groups, 80, 100)
            assert len(pairs) == len(set(start)) - len(set(groups))
            found.append(collections.Counter(frozenset(np.flatnonzero(groups == g)) for g in set(groups.tolist())))
        assert found[0] == found[1]


def test_weights_of_ngrams():
    rng = np.random.default_rng(1)
    grams = np.unique(np.concatenate([rng.integers(0, 1 << 64, 3000, np.uint64), np.arange(50, dtype=np.uint64), np.uint64((1 << 64) - 1) - np.arange(20, dtype=np.uint64)]))
    values = rng.integers(1, 40, len(grams)).astype(np.int8)
    asked = np.concatenate([grams, rng.integers(0, 1 << 64, 3000, np.uint64)])
    known = dict(zip(grams.tolist(), values.tolist()))
    for n in (len(grams), 1, 0):
        some = dict(list(known.items())[:n])
        assert ngram_join.Weights(grams[:n], values[:n]).of(asked).tolist() == [some.get(g, 0) for g in asked.tolist()]


def test_op4_odd_rows(spark, odd):
    got = collections.Counter((r.doc_id, r.component_id) for r in ngram_join.groups(odd).collect())
    assert got == collections.Counter((k, {5: 4}.get(k, k)) for k, _ in ODD)
    assert ngram_join.groups(odd.limit(0)).count() == 0
    stays = ngram_join.one_of_each(odd)
    assert stays.columns == odd.columns
    assert sorted((r.doc_id or 0) for r in stays.collect()) == [0, 0, 3, 4, 7, 9, 10, 11, 12, 13, 14]


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i + 1000, i + 1001) for i in range(40)]
    label = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in range(300):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = dict(graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == label


# ---- 5 packing ------------------------------------------------------------------------------------


def check_packing(rows, ids_of):
    for key, ids in ids_of.items():
        own = sorted((r for r in rows if r.doc_id == key), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))] and sum(r.length for r in own) == len(ids)
        assert all(r.length == 2048 for r in own[1:])
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by_sequence)


def test_op5_over_the_table(spark, texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = run(spark, "op5_packing")
    ids = {k: [*model.encode(t or "", add_special_tokens=False).ids, 0] for k, t in texts.items()}
    bins = check_packing(rows, ids)
    assert bins <= 1.01 * -(-sum(map(len, ids.values())) // 2048) + 1


def test_word_by_word_encoding_is_that_of_the_whole_text():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    model, mine = Tokenizer.from_file(path), packing.Encoder(open(path, encoding="utf-8").read())
    rng = random.Random(9)
    parts = ["a", " ", "\n", "  ", "\t", "it's", "don't", "12", "é", "字", "<|endoftext|>", " ", "\0", "!?", "x y", "\r\n", "'ll"]
    parts += ["élan.", "naïve,'s", " Straße!!", "ªº", "µ", "\u02b0x", "a\u0301", "A-b", "x'", "'s"]
    sample = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(6000)]
    want = [np.array(model.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in sample]
    assert mine(sample) == want


def test_packing_beats_nothing_less_than_best_fit_and_loses_no_piece(spark):
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 1400, 600)
    first = packing.Packing(sizes, 2048).place(np.argsort(-sizes, kind="stable"))
    bins = packing.evolve(sizes, 2048, 1, [])
    assert len(np.unique(bins)) <= len(first.left) and (np.bincount(bins, weights=sizes) <= 2048).all() and (bins >= 0).all()
    other = packing.Packing(sizes, 2048).place(rng.permutation(len(sizes)))
    mixed = packing.child(first, other, rng)
    assert (mixed.bin >= 0).all() and (np.bincount(mixed.bin, weights=sizes) == 2048 - np.array(mixed.left)).all()


def test_op5_odd_rows(spark, odd):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = packing.pack_documents(odd, path).collect()
    assert collections.Counter(r.doc_id for r in rows if r.piece == 0) == collections.Counter(k for k, _ in ODD)
    assert packing.pack_documents(odd.limit(0), path).count() == 0
    keyed = odd.filter("doc_id >= 4")
    placed = packing.pack_documents(keyed, path)
    placed.write.parquet(where := shared_dir(spark, "placed"))
    made = packing.sequences(spark.read.parquet(where), packing.pieces(keyed, path))
    assert sum(len(r.ids) // 4 for r in made.collect()) == sum(r.length for r in spark.read.parquet(where).collect())


# ---- 6 chat ---------------------------------------------------------------------------------------


def plain_chat(rows):
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns = [t[2:] for t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return out


def test_op6_over_the_table(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    given += [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
    got = {r.conv_id: tuple(r)[1:5] for r in run(spark, "op6_chat")}
    assert got == plain_chat(given)


def test_tree_emits_each_prefix_once_and_attention_is_the_path(spark):
    rows = []
    for conv, path in enumerate(["ab", "ab", "abc", "abd", "x", "ae", "", "abdf"]):
        rows += [(conv, i, "user" if i % 2 == 0 else "assistant", c * 3) for i, c in enumerate(path)]
    rows += [(50, None, None, None), (None, 1, "a:ssistant", "#<\\ ### </turn>\n"), (None, 1, "assistant", "#")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("rank", F.lit(1))
    tree, paths = chat.prefix_tree(df)
    nodes = {(r.hi, r.lo, r.depth): r for r in tree.collect()}
    assert len(nodes) == 7 + 1 + 2  # a ab abc abd abdf ae x, the empty turn, two of the null conversation
    spans = sorted((r.offset, r.offset + r.n) for r in nodes.values())
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))  # one stream without gaps
    by_conv = collections.defaultdict(list)
    for p in paths.collect():
        by_conv[p.conv].append((p.depth, nodes[(p.hi, p.lo, p.depth)]))
    for own in by_conv.values():
        own = [n for _, n in sorted(own, key=lambda x: x[0])]
        for i, n in enumerate(own):
            assert n.position == sum(x.n for x in own[:i])
            seen = {t for a in n.attend for t in range(a.start, a.end)}
            assert seen == {t for x in own[: i + 1] for t in range(x.offset, x.offset + x.n)}
    depth_first = sorted(nodes.values(), key=lambda r: r.offset)
    stack = []
    for n in depth_first:
        stack = stack[: n.depth - 1]
        assert (stack[-1].hi, stack[-1].lo) == (n.up_hi, n.up_lo) if stack else n.depth == 1
        stack.append(n)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(tree, paths).collect()}
    assert got == plain_chat(rows)
    assert chat.read_back(*chat.prefix_tree(df.limit(0))).count() == 0


def test_intervals_stay_few_on_a_long_path_with_many_branches(spark):
    spine = [(None, i, "user", f"t{i}") for i in range(200)]  # one conversation without an id; others leave it at each turn
    rows = spine + [(c, i, "user", f"t{i}" if i < c else "leaf") for c in range(0, 200, 3) for i in range(c + 1)]
    tree, paths = chat.prefix_tree(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    nodes = tree.select("depth", "hi", "lo", "offset", "n", "position", "attend").collect()
    total = sum(r.n for r in nodes)
    assert len(nodes) == 200 + 67 and sorted(x for r in nodes for x in range(r.offset, r.offset + r.n)) == list(range(total))
    assert all(sum(a.end - a.start for a in r.attend) == r.position + r.n and r.attend[-1].end == r.offset + r.n for r in nodes)
    assert max(len(r.attend) for r in nodes) <= total.bit_length()
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(tree, paths).collect()}
    assert got == plain_chat(rows)


def test_siblings_of_one_parent_over_many_parts(spark):
    rng = random.Random(3)
    sizes = [(1 + i % 3, i, -i, None if i % 3 == 0 else i % 2, None if i % 3 == 0 else 5, rng.randrange(1, 99)) for i in range(600)]
    df = spark.createDataFrame(sizes, "depth int, hi bigint, lo bigint, up_hi bigint, up_lo bigint, size bigint")
    df = df.withColumns({"n": F.lit(1), "position": F.lit(0), "owner": F.lit(0)})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = {r.hi: r.before for r in chat._before(df).collect()}
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want, sums = {}, collections.Counter()
    for depth, hi, lo, a, b, size in sorted(sizes, key=lambda r: (-r[5], r[1], r[2])):
        want[hi] = sums[depth, a, b]
        sums[depth, a, b] += size
    assert got == want


# ---- 7 secrets ------------------------------------------------------------------------------------

ASSIGN = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
BASE_SECRETS = [rf"""({ASSIGN})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"AKIA[A-Z0-9]+", r"[0-9a-f]+"]


def plain_secrets(text):
    out = []
    for place, pattern in enumerate(BASE_SECRETS):
        for m in re.finditer(pattern, text or ""):
            if (len(m[2]) >= 6) if place == 0 else len(m[0]) >= (20 if place == 1 else 24):
                out.append((m.start(), place, m.end()))
    return ",".join(f"{secret_scan.BASE[p].kind}:{s}:{e}" for s, p, e in sorted(out))


def test_op7_over_the_table(spark, texts):
    for r in run(spark, "op7_secrets"):
        line = plain_secrets(texts[r.doc_id])
        assert r.base_sha256 == sha(line) and set(filter(None, line.split(","))) <= set(r.spans.split(","))
        assert [r.n_assign, r.n_access, r.n_hex] == [line.count(f"{x.kind}:") for x in secret_scan.BASE]


def test_op7_adversarial_texts(spark):
    rng = random.Random(8)
    parts = ["token", "TOKEN", "=", ":", " ", '"', "abc", "0123456789abcdef", "AKIA", "ABCDEFGH12345678", "é字", "api_key", "Secret", "\n", "passwd: "]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    secret_scan.scan(df, ledger := shared_dir(spark, "ledger"), secret_scan.BASE)
    got = {r.doc_id: r.spans for r in secret_scan.digest(secret_scan.found_in(df, ledger, secret_scan.BASE)).collect()}
    assert got == {i: plain_secrets(t) for i, t in rows}


def test_ledger_scans_only_what_it_has_not_seen(spark, odd):
    ledger = shared_dir(spark, "ledger")
    docs = spark.createDataFrame([(1, "token=abcdefgh"), (2, "token=abcdefgh"), (3, "none"), (3, None)], "doc_id bigint, text string")
    secret_scan.scan(docs, ledger, secret_scan.BASE)
    assert secret_scan.read_ledger(spark, ledger).count() == 3  # blobs
    secret_scan.scan(docs, ledger, secret_scan.BASE)
    assert secret_scan.read_ledger(spark, ledger).count() == 3
    more = docs.union(spark.createDataFrame([(9, "AKIA" + "A" * 16)], docs.schema))
    secret_scan.scan(more, ledger, secret_scan.BASE)
    assert secret_scan.read_ledger(spark, ledger).count() == 4
    newer = [*secret_scan.BASE[:2], secret_scan.Rule("hex", "[0-9a-f]{8,}", version=2)]
    secret_scan.scan(more, ledger, newer)
    scanned = secret_scan.read_ledger(spark, ledger).select(F.explode("rules").alias("rule")).groupBy("rule").count()
    assert dict(scanned.collect()) == {"assign@1": 4, "access@1": 4, "hex@1": 4, "hex@2": 4}
    masked = {r.doc_id: r.text for r in secret_scan.redacted(more, ledger, rules=secret_scan.BASE).filter("text IS NOT NULL").collect()}
    assert masked == {1: "[SECRET]", 2: "[SECRET]", 3: "none", 9: "[SECRET]"}
    secret_scan.scan(odd, other := shared_dir(spark, "ledger"))
    assert secret_scan.redacted(odd, other).columns == odd.columns and secret_scan.redacted(odd, other).count() == len(ODD)
    secret_scan.scan(odd.limit(0), none := shared_dir(spark, "ledger"))
    assert secret_scan.found_in(odd.limit(0), none, into="hits").count() == 0


def test_secrets_run_no_python(spark, odd):
    plan = secret_scan.found_in(odd, shared_dir(spark, "ledger"), into="hits")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---- 8 archives -----------------------------------------------------------------------------------


def read_pages(spark, pages, size=64):
    folder = shared_dir(spark, "archives")
    warc.write_archives(warc.with_roles(pages), folder, size=size)
    return folder, warc.read_chunks(spark, folder, size=size)


def test_op8_over_the_table(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in run(spark, "op8_warc"):
        body = (pages[r.page_id] or "").encode()
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(body), hashlib.sha1(body).hexdigest(), "response", None)


def test_archives_keep_payloads_and_roles(spark):
    long, short = "é\r\n\r\nWARC/1.1 " * 100, "short"
    rows = [(1, "u1", long), (2, "u2", long), (2, "u2", long), (5, None, short), (6, "u\n6", short), (None, "u", None), (None, "u", long), (8, "v", ""), (9, "w", "x" * 999), (10, "w", "x" * 999)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"copy": F.lit(1), "chunk": F.lit(2)})
    folder, chunks = read_pages(spark, pages)
    got = chunks.collect()
    bodies = collections.defaultdict(list)
    for r in got:
        bodies[r.record].append((r.chunk, r.data, r.sha1, r.last, r.record_type, r.page, r.refers))
    assert len(bodies) == len(rows)
    roles = collections.Counter()
    for parts in bodies.values():
        parts.sort()
        whole = b"".join(p[1] for p in parts)
        assert [p[3] for p in parts] == [False] * (len(parts) - 1) + [True]
        assert max(len(p[1]) for p in parts) <= 64
        if parts[0][4] == "response":
            assert parts[-1][2] == hashlib.sha1(whole).hexdigest()
        roles[(parts[0][5], parts[0][4], parts[0][6], len(whole))] += 1
    n = len(long.encode())
    assert roles == collections.Counter(
        {("2", "response", None, n): 1, ("2", "revisit", "2", 0): 1, ("1", "revisit", "2", 0): 1, ("", "revisit", "2", 0): 1, ("", "response", None, 0): 1,
         ("5", "response", None, 5): 1, ("6", "response", None, 5): 1, ("8", "response", None, 0): 1, ("9", "response", None, 999): 1, ("10", "response", None, 999): 1}
    )
    empty = pages.limit(0)
    assert read_pages(spark, empty)[1].count() == 0


# ---- 9 byte pairs ---------------------------------------------------------------------------------


def test_op9_over_the_table(spark, texts):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        enc = bytepairs.encoder(f.read(), public_tokenizers.PATTERN)
    for r in run(spark, "op9_byte_pairs"):
        ids = enc.encode_ordinary(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(texts[r.doc_id] or ""))


def test_long_texts_split_only_where_nothing_spans():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        enc = bytepairs.encoder(f.read(), public_tokenizers.PATTERN)
    rng = random.Random(6)
    units = ["word", " ", "  ", "\n", "it's", " 12", "é ", "字", " !", "\t", " x", "<|endoftext|>"]
    for long in (5, 40):
        for _ in range(300):
            text = "".join(rng.choice(units) for _ in range(rng.randint(0, 60)))
            assert "".join(bytepairs.parts(text, long)) == text
            ids = bytepairs.encode(enc, [text], long)[0]
            assert ids.tolist() == enc.encode_ordinary(text) and bytepairs.decode(enc, ids) == text.encode()
    assert bytepairs.decode(enc, np.array([255 - 1], "<u4"))  # a byte that is no text alone


def test_op9_odd_rows(spark, odd):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = bytepairs.encoded(odd, path, public_tokenizers.PATTERN)
    back = collections.Counter((r.doc_id, bytes(r.bytes)) for r in bytepairs.decoded(ids, path, public_tokenizers.PATTERN).collect())
    assert back == collections.Counter((k, (t or "").encode()) for k, t in ODD)
    assert bytepairs.round_trip(odd, path, public_tokenizers.PATTERN).count() == len(ODD)
    assert bytepairs.round_trip(odd.limit(0), path, public_tokenizers.PATTERN).count() == 0


# ---- 10 quality -----------------------------------------------------------------------------------


def plain_quality(text, least=8):
    """Counts as in quality.COUNTS, then the words in repeated passages of MIN_PASSAGE or more; windows by sums of word numbers' powers."""
    w = WORD.findall(text or "")
    n, prime = len(w), (1 << 61) - 1
    number = {x: i + 1 for i, x in enumerate(dict.fromkeys(w))}
    sums, powers = [0], [1]
    for x in w:
        sums.append((sums[-1] * 1_000_003 + number[x]) % prime)
        powers.append(powers[-1] * 1_000_003 % prime)

    def windows(k):
        return [(sums[i + k] - sums[i] * powers[k]) % prime for i in range(n - k + 1)]

    def repeated(k):
        own = windows(k)
        counts, edge = collections.Counter(own), [0] * (n + 1)
        for i, x in enumerate(own):
            if counts[x] > 1:
                edge[i] += 1
                edge[i + k] -= 1
        inside, total = 0, 0
        for step in edge:
            inside += step
            total += inside > 0
        return total

    low, high = 0, n  # a sequence that repeats has repeated parts of every shorter length
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if len(set(windows(middle))) < n - middle + 1 else (low, middle - 1)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return (n, sum(map(len, w)), symbols, len(lines) - len(set(lines)), repeated(3), low, repeated(least), repeated(quality.MIN_PASSAGE))


def plain_verdict(counts):
    """(base_failed, kept) by the rule as it is stated: fixed limits, each of which rejects on its own."""
    n, repeat, longest, passages = counts[0], counts[4], counts[5], counts[7]
    failed = n < 50 or 100 * repeat > 50 * n
    return failed, not failed and passages <= 0.2 * n and not (longest > 30 and longest > 0.05 * n)


def test_repeats_of_random_texts():
    rng = random.Random(1)
    units = ["a", "b", " ", "\n", "c", "a b c d ", "é#", " x\n", "\n\n", "foo bar baz\n", "|"]
    sample = ["".join(rng.choice(units) for _ in range(rng.randint(0, 50))) for _ in range(400)] + ["", "\n", "a " * 70]
    data, offsets = words.from_texts(sample)
    got = quality.measure(data, offsets, 4)
    for i, t in enumerate(sample):
        assert tuple(int(got[c][i]) for c in [*quality.COUNTS, "n_passage_words"]) == plain_quality(t, 4), t


def test_op10_over_the_table(spark, texts):
    for r in quality.judged(spark.read.parquet(f"{SF}/documents.parquet")).collect():
        want = plain_quality(texts[r.doc_id])
        assert tuple(r[c] for c in [*quality.COUNTS, "n_passage_words"]) == want
        assert (r.base_failed, r.kept) == plain_verdict(want)


def made_texts():
    """Texts that one limit alone rejects, that lie at a limit, and that pass; {doc_id: (text, kept)}."""
    fresh = iter(f"w{i}" for i in range(10**6))
    take = lambda n: " ".join(next(fresh) for _ in range(n))
    pieces, quarter = [take(100) for _ in range(10)], [take(25) for _ in range(4)]
    one, edge = take(360), take(30)
    return {
        1: (" ".join([take(3000), *pieces, *pieces[::-1]]), False),  # 40 percent in passages of 2 percent each
        2: (f"{take(2640)} {one} {take(2640)} {one}", False),  # one passage of 6 percent, 12 percent covered
        3: (" ".join([take(480), *quarter, *quarter[::-1]]), False),  # passages of 25 words, under a third of the text
        4: (f"{take(300)} {edge} {take(40)} {edge}", True),  # 30 words, the most that one passage may have in a short text
        5: (" ".join([take(800), *quarter, *quarter[::-1]]), True),  # exactly a fifth
        6: (take(5000), True),
        7: (take(49), False),
        8: ("a b c " * 40, False),
        9: (None, False),
    }


def test_op10_and_its_sql_on_texts_at_every_limit(spark):
    import duckdb

    made = made_texts()
    got = {r.doc_id: r for r in quality.judged(spark.createDataFrame([(k, t) for k, (t, _) in made.items()], "doc_id bigint, text string")).collect()}
    assert {k: r.kept for k, r in got.items()} == {k: kept for k, (_, kept) in made.items()}
    assert {k: plain_verdict(plain_quality(t)) for k, (t, _) in made.items()} == {k: (r.base_failed, r.kept) for k, r in got.items()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(k, t) for k, (t, _) in made.items()])
    rows = con.execute(queries.ORACLES["op10_quality"]).df()
    assert dict(zip(rows["doc_id"], rows["kept"])) == {k: kept for k, (_, kept) in made.items()}


def test_op10_keeps_clean_texts_and_drops_copied_blocks(spark):
    rng = random.Random(12)
    fresh = " ".join(f"w{rng.randrange(10**6)}" for _ in range(400))
    block = " ".join(f"v{i}" for i in range(60))
    df = spark.createDataFrame([(1, fresh), (2, f"{block} {fresh[:600]} {block}"), (3, "same words again " * 40)], "doc_id bigint, text string")
    assert {r.doc_id: r.kept for r in quality.judged(df).collect()} == {1: True, 2: False, 3: False}
    assert [r.doc_id for r in quality.kept_rows(df).collect()] == [1]


def test_op10_rules_on_passages_each_reject_alone(spark):
    fresh = iter(f"w{i}" for i in range(10**6))
    take = lambda n: " ".join(next(fresh) for _ in range(n))
    pieces = [take(100) for _ in range(10)]  # 2,000 of 5,000 words in passages of 2 percent each
    many = " ".join([take(3000), *pieces, *pieces[::-1]])
    one = take(360)  # 6 percent of a long text, twice: 12 percent covered
    notice = take(13)  # a line such as clean documents repeat, 40 percent of the text
    short = " ".join(f"{take(20)} {notice}" for _ in range(30))
    rows = [(1, many), (2, f"{take(2640)} {one} {take(2640)} {one}"), (3, short), (4, f"{take(2500)} {pieces[0]} {take(2300)} {pieces[0]}")]
    got = {r.doc_id: r for r in quality.judged(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert not any(r.base_failed for r in got.values()) and {k: r.kept for k, r in got.items()} == {1: False, 2: False, 3: True, 4: True}
    assert got[1].n_passage_words == 2000 and got[1].longest_repeat == 100  # within the limit on the longest
    assert got[2].n_passage_words <= 0.2 * got[2].n_words and got[3].n_covered_words > 0.2 * got[3].n_words


def test_op10_odd_rows(spark, odd):
    rows = quality.judged(odd).collect()
    assert collections.Counter((r.doc_id, r.n_words) for r in rows) == collections.Counter((k, len(WORD.findall(t or ""))) for k, t in ODD)
    assert quality.judged(odd.limit(0)).count() == 0 and quality.kept_rows(odd).columns == odd.columns


# ---- SQL ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_its_sql(spark, name):
    import duckdb

    from tools.check_queries import TABLES, cells

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    mine, theirs = queries.QUERIES[name](spark, SF).toPandas(), con.execute(queries.ORACLES[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns) and cells(mine) == cells(theirs)


def test_archive_members_of_any_size_read_back():
    import io

    rng = random.Random(21)
    bodies = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 7, 63, 64, 65, 500]))) for _ in range(300)]
    out = io.BytesIO()
    writer = warc.Writer(out, "2000-01-01T00:00:00Z")
    for i, body in enumerate(bodies):
        writer.begin({"at": str(i), "copy": 1, "url": None, "n_bytes": len(body), "sha1": hashlib.sha1(body).hexdigest(), "refers": None})
        for a in range(0, len(body), 50):
            writer.data(body[a : a + 50])
    writer.end()
    for part in (1, 3, 64, 1000, 1 << 16):
        raw = io.BytesIO(out.getvalue())
        source = warc._Members(raw, part)
        whole = b""
        while source.more():
            whole += bytes(source.held)
            source.held.clear()
        assert whole.count(b"WARC-Type: response") == 300
    got = collections.defaultdict(bytes)
    for headers, _, data, _ in warc.records(io.BytesIO(out.getvalue()), 64):
        got[headers["warc-record-id"]] += data
    assert list(got.values()) == bodies


def test_sieve_never_loses_a_key(spark, monkeypatch):
    from quotewell.llm import sieve

    rows = spark.createDataFrame([(i if i % 7 else None, f"t{i}") for i in range(500)], "k bigint, slot string")
    keys = rows.filter("k % 3 = 0").select("k")
    for most in (1 << 26, 64):
        found = sieve.sieve(keys, "k", most)
        inside = {r.slot for r in sieve.sifted(rows, "k", found).collect()}
        outside = {r.slot for r in sieve.sifted(rows, "k", found, inside=False).collect()}
        assert not inside & outside and len(inside | outside) == 500
        assert {f"t{i}" for i in range(500) if i % 7 and i % 3 == 0} <= inside and "t7" in outside
    assert found.bits == 64 and sieve.sifted(rows.limit(0), "k", found).columns == ["k", "slot"]

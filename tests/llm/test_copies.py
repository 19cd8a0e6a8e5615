"""Repeated windows, benchmark passages and near copies against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from payfeed.llm import decontaminate, simhash, substrings
from payfeed.llm.files import BATCH_ROWS
from payfeed.session import staging


def made_texts(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randint(1, 4)))
    shared = " ".join(word() for _ in range(60))
    line = " ".join(word() for _ in range(12))
    texts = []
    for i in range(150):
        own = [word() for _ in range(rng.randint(0, 120))]
        text = " ".join(own)
        if i % 5 == 0:
            text += "\n" + shared + "\t" + " ".join(word() for _ in range(20))
        if i % 3 == 0:
            text = line + " " + text
        texts.append(text)
    texts += [texts[7]] * 40 + ["", " \n", "same " * 80, None, "x" * 20000]
    return texts


def edited(text, rng, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = "changed"
    return " ".join(words)


def test_repeated_windows(make_docs):
    rows = list(enumerate(made_texts())) + [(None, made_texts()[5]), (0, made_texts()[0])]
    docs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    counts = Counter(tuple(w[i : i + 35]) for w in docs for i in range(len(w) - 34))
    want = Counter()
    for (doc_id, _), words in zip(rows, docs):
        gone = [False] * len(words)
        for i in range(len(words) - 34):
            if counts[tuple(words[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        want[doc_id, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    got = substrings.remove_repeats(make_docs(rows))
    assert "ranges" in got.columns and "text_key" in got.columns
    found = got.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("h")).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.h) for r in found) == want
    assert sum(k[2] for k in want) > 2000


def test_small_chunks_and_many_buckets(make_docs, monkeypatch):
    rows = list(enumerate(made_texts(5)))
    whole = {r.doc_id: r.text for r in substrings.remove_repeats(make_docs(rows)).collect()}
    frequent, total = substrings.frequent_slots(make_docs(rows))
    assert total == sum(len((t or "").split()) for _, t in rows)
    chunks = [substrings._Chunk(), substrings._Chunk()]
    for i, text in rows:
        chunks[i % 2].add(i, 0, text)
    flags = np.zeros(substrings.SLOTS, bool)
    flags[frequent] = True
    sent = [r for k, c in enumerate(chunks) for r in c.rows(f"c{k}", flags, 7, 35)]
    strings = [r for r in sent if r[2] == 1]
    assert len({(r[1], r[3]) for r in strings}) == len(strings)  # a bucket hears once of each chunk
    assert len(whole) == len(rows)


def test_no_documents(make_docs, spark):
    empty = make_docs([])
    assert substrings.remove_repeats(empty).count() == 0
    assert simhash.near_duplicate_groups(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).count() == 0
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_phrases(empty, items, ["doc_id"]).count() == 0
    docs = make_docs([(1, "a b c")])
    assert decontaminate.find_phrases(docs, items, ["doc_id"]).first().item_ids == []


def test_word_hashes_follow_the_words():
    data = " a bb  a\n\x0bbb \u00e9\u00e8 \u00e8\u00e9 ab ba a".encode()
    got = substrings.word_hashes(data).tolist()
    words = data.split()
    assert len(got) == len(words)
    assert all((x == y) == (a == b) for x, a in zip(got, words) for y, b in zip(got, words))
    assert len(substrings.word_hashes(b"")) == len(substrings.word_hashes(b" \n")) == 0


def test_windows_of_equal_hash_are_told_apart(monkeypatch):
    """With a hash that knows eight values only, the words themselves decide."""
    rng = np.random.default_rng(2)
    real = substrings.rolled
    monkeypatch.setattr(substrings, "rolled", lambda values, size, factor: real(values, size, factor) % np.uint64(8))
    bucket, texts = substrings._Bucket(), []
    for chunk in range(6):
        strings = [" ".join("abc"[k] for k in rng.integers(0, 3, rng.integers(4, 12))) for _ in range(20)]
        distinct = list(dict.fromkeys(x.encode() for x in strings))
        often = np.array([strings.count(x.decode()) > 1 for x in distinct], np.uint8)
        bucket.add(str(chunk), substrings._packed(distinct, often))
        texts += [x.split() for x in strings]
    counts = Counter(tuple(x[i : i + 4]) for x in texts for i in range(len(x) - 3))
    order = [x.decode().split() for x in bucket.strings]
    found = bucket.ranges(4)
    covered = {(s, k) for s, a, b in found.T.tolist() for k in range(a, b)}
    for s, words in enumerate(order):
        for k in range(len(words)):
            inside = any(counts[tuple(words[i : i + 4])] > 1 for i in range(max(0, k - 3), min(k, len(words) - 4) + 1))
            assert ((s, k) in covered) == inside


def test_word_hashes_do_not_depend_on_where_data_is_cut(monkeypatch):
    rng = random.Random(5)
    data = "".join(rng.choice("ab \n\u00e9") * rng.randint(1, 40) for _ in range(400)).encode()
    whole = substrings.word_hashes(data).tolist()
    assert len(whole) == len(data.split())
    for size in (1, 7, 64):
        monkeypatch.setattr(substrings, "_AT_ONCE", size)
        assert substrings.word_hashes(data).tolist() == whole


def test_rolled_hashes_are_those_of_runs():
    values = np.random.default_rng(0).integers(0, 1 << 63, 50).astype(np.uint64)
    for size in (1, 2, 3, 4, 7, 35, 50):
        want = []
        for i in range(len(values) - size + 1):
            h = 0
            for v in values[i : i + size].tolist():
                h = (h * 12345677 + v) % (1 << 64)
            want.append(h)
        assert substrings.rolled(values, size, 12345677).tolist() == want


def brute_hits(rows, items):
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    cut = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item_id, text in items:
        words = cut.findall(low(text))
        for i in range(max(1, len(words) - 9) if words else 0):
            windows[tuple(words[i : i + 10])].add(str(item_id))
    out = []
    for doc_id, text in rows:
        words, hit, ids = cut.findall(low(text)), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    ids |= windows[tuple(words[i : i + size])]
        out.append((doc_id, len(words), len(hit), tuple(sorted(ids))))
    return Counter(out)


def test_benchmark_passages(spark, make_docs, monkeypatch):
    texts = made_texts(9)
    items = [(i, t) for i, t in enumerate(texts[:30])] + [(30, "ab"), (31, "cd ef"), (32, None), (33, "..."), (2, texts[2]), (34, texts[3])]
    rows = list(enumerate(made_texts(9)[20:])) + [(1000, "Ab, CD--ef! " * 30), (1001, "É" + texts[4].upper() if texts[4] else "x"), (None, texts[1])]
    table = spark.createDataFrame(items, "item_id long, text string")
    want = brute_hits(rows, items)
    for most in (100_000, 300):  # one block of phrases, and several
        monkeypatch.setattr(decontaminate, "PHRASES", most)
        found = decontaminate.find_phrases(make_docs(rows), table, ["doc_id", "lang"])
        got = found.select("doc_id", "n_words", decontaminate.n_hit().alias("n_hit"), "item_ids").collect()
        assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in got) == want
    assert sum(k[2] > 0 for k in want) > 10


def test_index_finds_and_locates():
    rng = np.random.default_rng(1)
    values = np.append(rng.integers(1, 4, 400), 0)
    index = decontaminate.FMIndex(values, 4, sample=7)
    assert index.locate(np.arange(len(values))).tolist() == decontaminate.suffix_order(values).tolist()
    text = values.tolist()
    for size in (1, 2, 5):
        for start in range(0, 390, 17):
            phrase = text[start : start + size]
            low, high = index.search(np.array([phrase]), np.array([size]))
            found = sorted(index.locate(np.arange(low[0], high[0])).tolist())
            assert found == [i for i in range(len(text) - size) if text[i : i + size] == phrase]


def test_spans_are_cut_from_the_text(spark, make_docs):
    passage = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"Before it. {passage.upper()}, after."), (2, "Clean  text\nstays.")]
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    docs = make_docs(rows)
    found = decontaminate.find_phrases(docs, items, ["doc_id"]).join(docs.select("doc_id", "text"), "doc_id")
    got = {r.doc_id: r.text for r in decontaminate.without_spans(found, ["doc_id"]).collect()}
    assert got == {1: "Before it. , after.", 2: "Clean  text\nstays."}
    assert {r.doc_id: r.text for r in decontaminate.find_phrases(docs, items, ["doc_id"], cut=True).collect()} == got


@pytest.mark.parametrize("block", [100_000, 3])
def test_cutting_while_searching_gives_the_same_texts(spark, make_docs, monkeypatch, block):
    """Spans that touch, overlap, or lie at the ends; null, empty and repeated rows; phrases in one block or many."""
    monkeypatch.setattr(decontaminate, "PHRASES", block)
    one, two = (" ".join(f"{c}{i}" for i in range(12)) for c in "ab")
    texts = [None, "", "  \n", one, f"{one} {two}", f"x {one}\n{one} y", f"{two}, z {one[:20]}", "clean Text, stays \u00e9", f"a {one.upper()} b {two} c"]
    docs = make_docs([*enumerate(texts), (3, one)])
    items = spark.createDataFrame([(1, one), (2, two), (3, None)], "item_id long, text string")
    found = decontaminate.find_phrases(docs, items, ["doc_id", "text"])
    apart = decontaminate.without_spans(found, ["doc_id"])
    assert apart.count() == len(texts) + 1
    at_once = decontaminate.find_phrases(docs, items, ["doc_id"], cut=True)
    assert at_once.columns == ["doc_id", "text"]
    order = lambda rows: sorted((r.doc_id, r.text is None, r.text or "") for r in rows.collect())
    assert order(at_once) == order(apart)
    assert order(at_once)[0][1] and (7, False, texts[7]) in order(at_once)


def test_simhash_components(make_docs):
    rng = random.Random(4)
    texts = made_texts(11)
    rows = list(enumerate(texts)) + [(1000 + i, edited(texts[i], rng, 1)) for i in range(60) if texts[i].split()]
    prints = {}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        pieces = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
        hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in pieces]
        prints[doc_id] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in ids:
            if j < i and (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicate_groups(make_docs(rows)).collect()}
    assert got == {i: (f"{prints[i]:016x}", find(i)) for i in ids}


def test_every_pair_in_reach_is_linked(spark):
    rng = random.Random(8)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = set(base)
    for p in base:
        for _ in range(6):
            q = p
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                q ^= 1 << bit
            prints.add(q)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "fingerprint long"), 3)
    roots = {r.node % (1 << 64): r.root for r in simhash.components(edges).collect()}
    for p in prints:
        for q in prints:
            if p != q and (p ^ q).bit_count() <= 3:
                assert roots[p] == roots[q]


def test_blocks_of_a_hot_entry(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    prints = [((7 << 32) | (1 << i) | (1 << j),) for i in range(20) for j in range(i)]
    edges = simhash.links(spark.createDataFrame(prints, "fingerprint long"), 3)
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    assert len(roots) == len(prints) and len(set(roots.values())) == 1
    assert edges.count() < 40 * len(prints)


def test_one_document_of_each_component_stays(make_docs):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    texts = [" ".join(word() for _ in range(rng.randint(60, 300))) for _ in range(60)]
    rows = list(enumerate(texts)) + [(100 + i, texts[i].upper()) for i in range(5)]
    rows += [(200 + i, edited(texts[10 + i], rng, 1)) for i in range(20)] + [(300 + i, edited(texts[40], rng, 1)) for i in range(30)]
    rows += [(7, texts[7]), (7, texts[7]), (None, texts[8]), (None, "alone without id"), (None, None), (400, ""), (401, " ")]
    docs = make_docs(rows)
    got = simhash.drop_near_duplicates(docs)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes

    prints = [simhash.simhash(t, 3) for _, t in rows]
    root = list(range(len(rows)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and find(i) != find(j):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        groups[find(i)].append((doc_id is None, doc_id or 0))
    want = Counter(None if x[0] else x[1] for x in map(min, groups.values()))
    assert Counter(r.doc_id for r in got.collect()) == want
    assert 60 <= sum(want.values()) < len(rows) - 40


def test_rows_repeated_in_full_leave_one(spark):
    texts = [f"{i} " + " ".join(f"w{i}x{j}" for j in range(40)) for i in range(20)]
    rows = [(i, t, {"n": i}) for i, t in enumerate(texts)] + [(None, "no id but a text", {"n": -1}), (None, None, {"n": -2}), (3, "another text of the same id", {"n": 3})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, more map<string, int>")
    once, thrice = (sorted(map(str, simhash.drop_near_duplicates(x).collect())) for x in (docs, docs.union(docs).union(docs)))
    assert once == thrice and len(once) == len(rows)


def staged_bytes(folder):
    return sum(f.stat().st_size for f in Path(folder).rglob("*.parquet"))


def test_what_grows_with_the_texts_is_merged(monkeypatch, spark, make_docs):
    plans, real = [], simhash.materialize
    planned = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df
    for module in (simhash, substrings):
        monkeypatch.setattr(module, "materialize", lambda df, label: real(planned(df), label))
    common = " ".join(f"w{i}" for i in range(60))
    docs = make_docs([(i, f"{common} {i // 2} {i // 2}") for i in range(40)] + [(1, f"{common} 0 0")])
    for found in (simhash.near_duplicate_groups(docs), simhash.drop_near_duplicates(docs), substrings.remove_repeats(docs)):
        assert planned(found).count() > 0
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) >= 10 << 20
    assert sum("SortMergeJoin" in plan for plan in plans) > 8
    assert not any("Broadcast" in plan for plan in plans)


def test_texts_are_not_staged_for_near_duplicates(spark, make_docs):
    rng = random.Random(12)
    docs = make_docs([(i, " ".join(f"{rng.getrandbits(64):x}" for _ in range(400))) for i in range(300)])
    with staging(spark) as folder:
        assert simhash.drop_near_duplicates(docs).count() == 300
        assert staged_bytes(folder) < 300 * 400 * 16 / 4


def test_repeated_windows_are_counted_before_texts_are_shuffled(make_docs):
    passage = " ".join(f"p{i}" for i in range(50))
    docs = make_docs([(i, f"{passage} " + " ".join(f"w{i}x{j}" for j in range(60))) for i in range(30)])
    found = substrings.remove_repeats(docs)
    assert {r.n_removed for r in found.collect()} == {50}
    assert "MapInPandas" not in found._jdf.queryExecution().executedPlan().toString()  # these sent and counted the strings


@pytest.mark.parametrize("batch", [1, 2, 3])
def test_links_do_not_depend_on_batches(spark, batch):
    rng = random.Random(14)
    base = [rng.getrandbits(62) for _ in range(12)]
    # Three bits over both halves: the pair meets in one table, as an entry and one that looks.
    prints = base + [p ^ (1 << rng.randrange(0, 32)) ^ (1 << (a := rng.randrange(32, 46))) ^ (1 << (a + 14)) for p in base]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        edges = simhash.links(spark.createDataFrame([(p,) for p in prints], "fingerprint long"), 3)
        roots = {r.node: r.root for r in simhash.components(edges).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    assert all(roots.get(p) == min(p, q) and roots.get(q) == min(p, q) for p, q in zip(base, prints[12:]))


NAMES = ["a.b", "_id", "_text", "_node", "_key", "_copy", "_row", "_new", "_ranges", "ROW", "fingerprint", "n", "N_Words", "_n", "chunk", "kind"]


def odd_table(spark, n=40):
    rng = random.Random(1)
    text = lambda i: " ".join(rng.choice(["red", "green", "blue", "pale", "dark"]) for _ in range(60)) if i % 4 else "same words here " * 20
    rows = [(i, text(i), "en", *[f"{name}{i}" for name in NAMES]) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", "lang string", *[f"`{x}` string" for x in NAMES]]))


def test_columns_of_any_name_come_back(spark):
    docs = odd_table(spark)
    before = {r.doc_id: tuple(r)[3:] for r in docs.collect()}
    for found in (simhash.drop_near_duplicates(docs), substrings.remove_repeats(docs.drop("N_Words"))):
        kept = [c for c in docs.columns[3:] if c in found.columns]
        assert len(kept) >= len(NAMES) - 1
        for r in found.select("doc_id", *[F.col(f"`{c}`") for c in kept]).collect():
            assert list(tuple(r)[1:]) == [v for c, v in zip(NAMES, before[r.doc_id]) if c in kept]


def test_pipeline_stages_keep_columns_of_any_name(spark, sf_dir):
    import corpus_pipeline

    docs = odd_table(spark)
    before = {r.doc_id: tuple(r)[3:] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs_out = stage(spark, docs, sf_dir)
        assert docs_out.columns == docs.columns and docs_out.dtypes == docs.dtypes, name
        assert all(tuple(r)[3:] == before[r.doc_id] for r in docs_out.collect()), name

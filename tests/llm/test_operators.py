"""Operators against plain versions, over odd rows: nulls, blanks, long texts, copies, one id twice, clashing columns."""

import hashlib
import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from lumenframe.llm import blocks, decontaminate, fertility, lines, mixing, pitmanyor, simhash, substrings, suffixes, tokenfiles, toxicity, vocabularies
from lumenframe.llm.queries import ORACLE, QUERIES
from lumenframe.llm.vocabularies import ByteTokenizer, public_path, units
from tests.compare import differences

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key long, size long, _key string, __id int"
SF_DIR = "/root/testdata/sf0.001"


def odd_rows():
    rng = random.Random(5)
    vocabulary = [f"wörd{i}" if i % 9 == 0 else f"w{i}" for i in range(400)]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    shared, long = text(120), text(30_000)
    texts = [None, "", "  \n\t ", "one", "two words", long, long, shared, shared + " tail", "head " + shared, "a " * 200, "x" * 5000, "漢字 " * 80]
    texts += [text(rng.randint(1, 150)) for _ in range(40)] + ["\n".join(["same line", "next line", "last line", text(5)]) for _ in range(4)]
    rows = [(i, t, "en", ["b", "a", None, "é"][i % 4]) for i, t in enumerate(texts)]
    rows += [(7, shared, "en", "b"), (7, text(80), None, "a"), (None, shared, "en", None), (None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return odd_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, "x", 5) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def many(got):
    return Counter(tuple(r) for r in got)


def order(doc_id):
    return -(1 << 63) if doc_id is None else doc_id


def test_substrings(docs, rows, empty):
    size, words = 35, [(i, (t or "").encode().split()) for i, t, *_ in rows]
    seen = Counter(tuple(w[k : k + size]) for _, w in words for k in range(len(w) - size + 1))
    wanted = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if seen[tuple(w[k : k + size])] > 1:
                gone[k : k + size] = [True] * size
        wanted.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g)))
    got = substrings.remove_repeated_windows(docs).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert many((r[0], r[1], r[2], bytes(r[3])) for r in got) == many(wanted)
    assert substrings.remove_repeated_windows(empty).count() == 0


def test_suffixes(docs, rows, empty):
    size, first = 100, {}
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    for i, b in texts:
        for p in range(len(b) - size + 1):
            s = b[p : p + size]
            first[s] = min(first.get(s, (1 << 63, 0)), (order(i), p))
    wanted = []
    for i, b in texts:
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - size + 1):
            if first[b[p : p + size]] < (order(i), p):
                gone[p : p + size] = True
        kept = bytes(np.frombuffer(b, dtype=np.uint8)[~gone])
        wanted.append((i, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    got = suffixes.remove_earlier_strings(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert many(got) == many(wanted)
    assert suffixes.remove_earlier_strings(empty).count() == 0


def test_suffixes_of_long_pieces(spark, monkeypatch, rows):
    docs = spark.createDataFrame([(i, t) for i, t, *_ in rows if i is not None and i < 7], "doc_id long, text string")
    whole = sorted(tuple(r) for r in suffixes.remove_earlier_strings(docs).drop("span_start", "span_end").collect())
    batch = [suffixes.Piece([t.encode()], 100).anchors()[2] for _, t, *_ in rows if t and len(t) > 1000]
    assert whole and all(len(b) for b in batch)


def test_lines(docs, rows, empty):
    texts = [(i, (t or "").split("\n")) for i, t, *_ in rows]
    first = {}
    for i, x in texts:
        for p in range(len(x) - 2):
            w = tuple(x[p : p + 3])
            first[w] = min(first.get(w, (1 << 63, 0)), (order(i), p))
    wanted = []
    for i, x in texts:
        gone = {q for p in range(len(x) - 2) if first[tuple(x[p : p + 3])] < (order(i), p) for q in range(p, p + 3)}
        wanted.append((i, len(x), len(gone), "\n".join(v for k, v in enumerate(x) if k not in gone)))
    assert many(lines.remove_earlier_lines(docs).collect()) == many(wanted)
    assert lines.remove_earlier_lines(empty).count() == 0


def test_fingerprints_and_groups(docs, rows, empty):
    def plain(text):
        w = (text or "").encode().lower().split()
        shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [plain(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                root[find(a)] = find(b)
    ids = {}
    for n, (i, *_) in enumerate(rows):
        if i is not None:
            ids[find(n)] = min(ids.get(find(n), i), i)
    wanted = many((i, fps[n], ids.get(find(n))) for n, (i, *_) in enumerate(rows))
    got = simhash.near_duplicates(docs).select("doc_id", "fp", "component_id").collect()
    assert many((r[0], r[1] % (1 << 64), r[2]) for r in got) == wanted
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len({find(n) for n in range(len(rows))})
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).count() == 0


def test_position_sets_and_forest():
    for distance, size in ((3, 2), (3, 3), (3, 4), (3, 5), (1, 4)):
        sets = simhash.position_sets(distance, size)
        for bad in range(1 << 8):
            if bad.bit_count() == distance:
                assert any(not any(bad >> p & 1 for p in s) for s in sets)
    fps = np.array([7 ^ (1 << b) for b in range(40)] + [1 << 63], dtype=np.uint64)
    edges = simhash.linked(np.unique(fps), 3)
    assert len(edges) == 40 and all((a ^ b).bit_count() <= 3 for a, b in edges)


def test_mixing(spark, docs, rows, empty):
    mixed = mixing.mix(docs, (3.0, 1.0, 2.0), 1.5).collect()
    assert len(mixed) == len(rows)
    size = {}
    for _, t, _, s in rows:
        size[s] = size.get(s, 0) + len((t or "").encode().split())
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    full, total = set(), 1.5 * sum(size.values())
    while True:
        left = total - sum(2 * size[s] for s in full)
        target = {s: 2 * size[s] if s in full else left * weight[s] / sum(weight[x] for x in names if x not in full) for s in names}
        over = {s for s in names if s not in full and target[s] > 2 * size[s]}
        if not over:
            break
        full |= over
    for s in names:
        own = [r for r in mixed if r["source"] == s]
        assert all(math.isclose(r["target"], target[s], rel_tol=1e-9) and r["source_size"] == size[s] for r in own)
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in own)
        largest = max(r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - target[s]) <= largest
    assert many(mixing.mix(docs.repartition(5), (3.0, 1.0, 2.0), 1.5).collect()) == many(mixed)
    out = mixing.mixed_documents(docs, (3.0, 1.0, 2.0), 1.5)
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in mixed)
    assert mixing.mix(empty, (1.0,), 1.5).count() == 0


def test_mixing_solves_the_dual(spark):
    sizes = spark.createDataFrame([("0a", n, 10) for n in (5, 50, 500)] + [("0b", 7, 3)], "src string, size long, n long")
    targets = spark.createDataFrame([("0a", 5550, 2500.0), ("0b", 21, 30.0)], "src string, source_size long, target double")
    for r in mixing.solve(sizes, targets).collect():
        own = [(s.size, s.n) for s in sizes.collect() if s.src == r.src]
        rates = [min(2.0, math.exp(r.lam * x / r.scale)) for x, _ in own]
        assert math.isclose(sum(x * n * q for (x, n), q in zip(own, rates)), r.target, rel_tol=1e-6)


def test_quality(docs, rows, empty):
    got = {(r["doc_id"], r["n_words"], r["word_chars"]): r for r in fertility.quality(docs).collect()}
    for i, t, *_ in rows:
        raw = (t or "").encode()
        w = raw.split()
        c = Counter(zip(w, w[1:], w[2:]))
        inside = {q for k in range(len(w) - 2) if c[tuple(w[k : k + 3])] > 1 for q in range(k, k + 3)}
        r = got[(i, len(w), sum(len(x.decode()) for x in w))]
        assert r["n_repeat_words"] == len(inside)
        lines = [x for x in (t or "").split("\n") if x.encode().split()]
        assert r["n_dup_lines"] == len(lines) - len(set(lines)) and r["n_symbols"] == sum(c in "#*$%&|<>" for c in t or "")
        assert r["base_failed"] == (len(w) < 50 or 100 * len(inside) > 50 * len(w)) and not (r["kept"] and r["base_failed"])
    kept = fertility.good_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in fertility.quality(docs).collect())
    assert fertility.quality(empty).count() == 0


def test_clashing_names(spark):
    text = " ".join(f"word{k}" for k in range(80))
    names = ["__measures", "__MEASURES_", "__lumenframe_row_id", "__lumenframe_row_key", "_doc", "id", "key", "fp"]
    docs = spark.createDataFrame([(1, text, "en", "s", *[7] * 8), (2, text, "en", "s", *[8] * 8)], ["doc_id", "text", "lang", "source", *names])
    benchmark = spark.createDataFrame([(1, "nothing that the documents would hold")], "item_id long, text string")
    for kept, n in ((fertility.good_documents(docs), 2), (simhash.one_of_each(docs), 1), (decontaminate.clean_documents(docs, benchmark), 2)):
        assert kept.columns == docs.columns and kept.count() == n
    assert mixing.mixed_documents(docs, (1.0,), 1.0).columns == docs.columns


def test_bytes_are_rejected(spark):
    names = ["river", "garden", "window", "letter", "summer", "teacher", "music", "bridge", "market", "forest", "paper"]
    clean = " ".join(f"{names[n % 11]} {names[n * n % 7]} number {n}" for n in range(60))
    junk = " ".join("ᚠᚢᚦ" + chr(0x16A0 + n % 70) * (n % 5 + 1) + str(n) for n in range(200))
    docs = spark.createDataFrame([(1, clean, "en"), (2, junk, "en")], "doc_id long, text string, lang string")
    bands = {"LATIN": fertility.BANDS["LATIN"], "": fertility.Band(0.9, 12.0, 0.3, 3.0)}
    assert [r["doc_id"] for r in fertility.good_documents(docs, bands=bands).collect()] == [1]


def test_bands_learnt_from_the_corpus_reject_junk(spark):
    rng = random.Random(8)
    parts = {"en": "the th in er an re on at en nd ti es or te of ed is it al ar".split(), "fr": "le de ou eau é è que ment tion en ai re ch et pas".split()}

    def prose(lang, n):
        return " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))

    def of(letters, n):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n))

    clean = [(n, prose(lang, rng.randint(55, 600)), lang) for n in range(200) for lang in (["en", "fr"][n % 2],)]
    letters, marks, runes = "abcdefghijklmnopqrstuvwxyz", "!?.,;:-()[]/+=", [chr(0x16A0 + k) for k in range(70)]
    junk = [(1000 + k, of(some, 300), lang) for k, (some, lang) in enumerate([(letters, "en"), (letters, "fr"), (letters, None), (marks, "en"), (marks, None), (runes, "en"), (runes, None)])]
    junk += [(2000 + k, of(letters, 300), "zz") for k in range(40)]  # a language of its own, enough to learn from
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string").repartition(3)
    assert sorted(r["doc_id"] for r in fertility.good_documents(docs).collect()) == [n for n, *_ in clean]
    assert {r["doc_id"] for r in fertility.quality(docs).where("kept").collect()} == {n for n, *_ in clean}


def test_units_are_encoded_as_the_whole():
    rng = random.Random(1)
    parts = [" ", " ", "  ", "\n", "\t", "a", "Ab", "é", "<|endoftext|>", "12", "!", "'s", "\r\n", "漢", " ", "\x1c"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    path = public_path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    tokenizer = ByteTokenizer(path)
    assert all("".join(units(t)) == t for t in texts)
    for size in (1, 7, 1000):  # units come again, in other company
        for at in range(0, 200 if size == 1 else len(texts), size):
            got = tokenizer.encode(texts[at : at + size], [0])
            assert got.to_pylist() == [[*w.ids, 0] for w in whole[at : at + size]]


def test_units_that_are_forgotten(monkeypatch):
    path = public_path("byte_bpe_50k.json")
    monkeypatch.setattr(vocabularies, "KNOWN_UNITS", 5)
    tokenizer, texts = ByteTokenizer(path), [f"word{i} word{i % 7} other{i % 3}  x" for i in range(60)]
    whole = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    for at in range(0, 60, 4):
        assert tokenizer.encode(texts[at : at + 4]).to_pylist() == [w.ids for w in whole[at : at + 4]]
    assert len(tokenizer.names) < 20
    assert len(tokenizer.encode([])) == 0


def test_token_files(spark, docs, rows, empty, tmp_path):
    folder = str(tmp_path / "orc")
    tokenfiles.write_tokens(docs, folder)
    tokenizer, wanted, at = Tokenizer.from_file(public_path("byte_bpe_50k.json")), {}, 0
    got = sorted(tokenfiles.checked_tokens(spark, folder).collect(), key=lambda r: r["start"])
    assert [order(r["doc_id"]) for r in got] == sorted(order(i) for i, *_ in rows)
    for i, t, *_ in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        wanted[(i, len(ids), zlib.crc32(ids.tobytes()))] = wanted.get((i, len(ids), zlib.crc32(ids.tobytes())), 0) + 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == wanted
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert tokenfiles.lookup(spark, folder, [3]).count() == 1
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 4)  # many files a task
    try:
        tokenfiles.write_tokens(docs, folder + "-many")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert len(spark.read.orc(folder + "-many").inputFiles()) >= len(rows) / 4
    assert Counter(map(tuple, tokenfiles.checked_tokens(spark, folder + "-many").collect())) == Counter(map(tuple, got))
    tokenfiles.write_tokens(empty, folder + "-empty")
    assert tokenfiles.checked_tokens(spark, folder + "-empty").count() == 0


def test_remembered_units_are_not_hashed_for_each_slice(monkeypatch):
    tokenizer, plain, tables = ByteTokenizer(public_path("byte_bpe_50k.json")), Tokenizer.from_file(public_path("byte_bpe_50k.json")), []
    index_in = vocabularies.pc.index_in
    monkeypatch.setattr(vocabularies.pc, "index_in", lambda values, value_set: tables.append(len(value_set)) or index_in(values, value_set=value_set))
    for texts in ([" ".join(f"word{n}" for n in range(5000))], ["and word7 then word8", "word4999 new"], ["", "word7 word7 other"]):
        assert tokenizer.encode(texts, [0]).to_pylist() == [[*plain.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert tables[0] == 4999 and max(tables[1:]) < 10


def test_language_model(spark, docs, rows, empty):
    got = pitmanyor.score_documents(docs).collect()
    texts = [(i, (t or "").encode().lower().split()) for i, t, *_ in rows]
    held = {i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, _ in texts}
    count = Counter(x for i, w in texts if not held[i] for x in [*w, None])
    n, v = sum(count.values()), len(count)
    wanted = Counter()
    for i, w in texts:
        base = sum(math.log10((count[x] + 1) / (n + v + 1)) for x in [*w, None])
        wanted[(i, held[i], len(w) + 1, sum(count[x] > 0 for x in [*w, None]), n, round(base, 6))] += 1
    assert Counter((*r[:5], round(r["base_score"], 6)) for r in got) == wanted
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
    assert pitmanyor.score_documents(empty).count() == 0


def test_seating_is_that_of_the_process():
    rng = np.random.default_rng(1)
    count, discount, pull = np.full(4000, 6), 0.5, np.full(4000, 0.7)
    plain = []
    for _ in range(4000):
        tables = 1
        for seated in range(1, 6):
            tables += rng.random() < 0.7 / (seated - discount * tables + 0.7)
        plain.append(tables)
    assert abs(pitmanyor.seat(count, pull, discount, rng).mean() - np.mean(plain)) < 0.1
    moved = pitmanyor.gibbs(count, pitmanyor.seat(count, pull, discount, rng), pull, discount, 3, rng)
    assert ((moved >= 1) & (moved <= 6)).all()


def stirling_weights(n, pull, discount):
    """Shares of 1 .. n tables of n customers in the stationary distribution, customer by customer."""
    w, k = np.zeros(n + 2), np.arange(n + 2)
    w[0] = 1.0
    for j in range(n):
        w = np.append(0.0, w[:-1]) * pull + np.maximum(j - discount * k, 0.0) * w
        w /= w.max()
    return w[1 : n + 1] / w[1 : n + 1].sum()


@pytest.mark.parametrize("pull", [1e-3, 1.0, 20.0, 400.0, 5000.0])
@pytest.mark.parametrize("discount", [0.05, 0.5, 0.75, 0.95])
def test_tables_are_drawn_from_the_stationary_distribution(pull, discount):
    for n in (1000, 3000):
        t, logs = pitmanyor.log_weights(n, pull, discount)
        wanted, got = stirling_weights(n, pull, discount), np.zeros(n)
        got[t - 1] = np.exp(logs - logs.max())
        assert np.abs(got / got.sum() - wanted).sum() < 1e-4
    rng = np.random.default_rng(2)
    for n in (2, 10, 400, 1000):
        wanted = stirling_weights(n, pull, discount)
        mean = (wanted * np.arange(1, n + 1)).sum()
        spread = math.sqrt((wanted * (np.arange(1, n + 1) - mean) ** 2).sum())
        got = pitmanyor.draw(np.full(200, n), np.full(200, pull), discount, rng)
        assert abs(got.mean() - mean) < 5 * spread / math.sqrt(200) + 0.02


def test_rounds_go_on_until_totals_have_settled(spark):
    rng = np.random.default_rng(8)
    words = []
    for _ in range(150):  # each word has its own likely successors
        k, some = 0, []
        for step, jump in zip(np.minimum(rng.zipf(1.6, 400), 5000).tolist(), (rng.random(400) > 0.85).tolist()):
            k = step if jump else (7 * k + step) % 3000
            some.append(f"w{k}")
        words.append(" ".join(some))
    texts = blocks.text_rows(spark.createDataFrame(list(enumerate(words)), "doc_id long, text string").repartition(3))
    hot = np.sort(pitmanyor.Words([b"w1 w2"]).hash)  # split by context
    rows = texts.mapInArrow(pitmanyor.pair_blocks(hot, 8), blocks.BLOCK).repartition(4, "bucket").cache()
    rounds = pitmanyor.all_rounds(rows, hot, 8, 24, 0)
    settled = np.mean([r.parent_customers for r in rounds[12:]])
    after = [abs(r.parent_customers / settled - 1) for r in rounds]
    assert len(rounds) == 25 and after[1] > 0.01 and after[pitmanyor.BURN_IN] < 0.005  # one round alone is far off
    assert all(r.tables.sum() == r.parent_customers for r in rounds)
    # the same rounds with all in one place
    held = dict(pitmanyor.own_buckets(iter(rows.toArrow().to_batches()), 8))
    own = [pitmanyor.moving(pitmanyor.Bucket(k, b), hot)[0] for k, b in held.items() if k >= 0]
    for n in range(3):
        parts = [pitmanyor.moved_sums(m, m.seat_again(rounds[n], n, 0), 2) for m in own]
        plain = pitmanyor.next_totals(rounds[n], [sum(x) for x in zip(*parts)], n, 0)
        assert (plain.tables == rounds[n + 1].tables).all() and plain.parent_tables == rounds[n + 1].parent_tables
        assert (plain.hot_customers == rounds[n + 1].hot_customers).all()
    rows.unpersist()


def test_contexts_are_told_apart(spark):
    hashes = pitmanyor.Words([b"v984 v1984 v1102"]).hash
    assert len({int(h >> np.uint64(20)) % 65535 for h in hashes[:2]}) == 1  # once one restaurant
    held = [i for i in range(200, 300) if zlib.crc32(str(i).encode()) % 7 == 2]
    texts = [(i, "v984 left" if i % 2 else "v1984 right") for i in range(120)]
    texts += list(zip(held, ["v984 left", "v984 right", "v1984 left", "v1984 right", "v1102 left", "v1102 right"]))
    got = pitmanyor.score_documents(spark.createDataFrame(texts, "doc_id long, text string").repartition(3)).collect()
    score = {text: r["score"] for r in got for i, text in texts[120:] if i == r["doc_id"]}
    assert score["v984 left"] > score["v984 right"] + 1 and score["v1984 right"] > score["v1984 left"] + 1
    assert abs(score["v1102 left"] - score["v1102 right"]) < 0.5  # of a context that was never seen


def test_totals_of_contexts_in_shards_are_those_of_the_array(spark):
    rng = np.random.default_rng(9)
    texts = [" ".join(f"w{k}" for k in np.minimum(rng.zipf(1.4, 60), 3000)) for _ in range(120)]
    docs = spark.createDataFrame([(i % 110, t) for i, t in enumerate(texts)] + [(None, texts[0]), (7, None), (8, "")], "doc_id long, text string").repartition(3)
    rows = blocks.text_rows(docs)
    names = np.unique(pitmanyor.Words([t.encode() for t in texts]).hash)
    hot = np.sort(pitmanyor.Words([b"w1 w2"]).hash)
    pairs = rows.mapInArrow(pitmanyor.pair_blocks(hot, 8), blocks.BLOCK).repartition(4, "bucket").cache()
    array = pitmanyor.all_rounds(pairs, hot, 8, 5, 0)
    few = pitmanyor.all_rounds(pairs, hot, 8, 5, 0, np.append(pitmanyor.START, names[::5]))
    pairs.unpersist()
    assert len(few[0].known) < len(array[0].known) / 4 and array[0].tables[pitmanyor.OTHERS] == 0 < few[0].tables[pitmanyor.OTHERS]
    places = pitmanyor.places_of(array[0].known, few[0].known)
    for a, b in zip(array, few, strict=True):
        assert (a.parent_customers, a.parent_tables, a.customers.sum(), a.tables.sum()) == (b.parent_customers, b.parent_tables, b.customers.sum(), b.tables.sum())
        for x, y in ((a.customers, b.customers), (a.tables, b.tables), (a.fixed, b.fixed)):
            assert (np.where(places == pitmanyor.OTHERS, 0, x[places]) == y[: len(places)]).all()
    # as are the scores, however words are sent
    some = [pitmanyor.scores(rows, hot, c, 3, 2, 0).collect() for c in (pitmanyor.NO_NAMES, np.append(pitmanyor.START, names), np.append(pitmanyor.START, names[::5]))]
    key = lambda r: (order(r["doc_id"]), r["n_tokens"], r["base_score"], r["score"])
    for other in some[1:]:
        for x, y in zip(sorted(some[0], key=key), sorted(other, key=key), strict=True):
            assert x[:5] == y[:5] and abs(x["base_score"] - y["base_score"]) < 1e-9 and abs(x["score"] - y["score"]) < 1e-4 * abs(x["score"])


def test_decontamination(spark, docs, rows, empty):
    rng = random.Random(2)
    item = [f"item{n}" for n in range(40)]
    reworded = [w if rng.random() > 0.1 else "other" for w in item]
    filler = [" ".join(f"f{rng.randint(0, 3000)}" for _ in range(300)) for _ in range(30)]
    more = [(100, filler[0] + " " + " ".join(item) + " " + filler[1]), (101, " ".join(reworded) + " " + filler[2]), (102, " ".join(sorted(item, key=lambda _: rng.random())))]
    more += [(200 + k, f) for k, f in enumerate(filler)]
    some = spark.createDataFrame(more, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, ""), (None, "unheard of item with words of its own")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(some, benchmark).collect()}
    assert found == {(100, 1), (101, 1)}  # the shuffled one has the words, not their order
    kept = decontaminate.clean_documents(some, benchmark)
    assert kept.columns == some.columns and kept.count() == some.count() - 2
    assert decontaminate.contaminated(empty, benchmark).count() == 0
    assert decontaminate.contaminated(docs, benchmark.limit(0)).count() == 0


def test_rewordings_at_the_limits_are_found(spark):
    rng = random.Random(6)
    common, rare = [f"c{n}" for n in range(200)], [f"r{n}" for n in range(60)]
    item = [w for a, b in zip(common[:12], rare[:12]) for w in (a, b)] + rare[12:20]  # half of it common words
    hidden = set(range(1, 24, 2)) - {1, 3, 5}  # what is left is common, in order, with the answer
    docs, wanted = [], set()
    for n in range(40):  # long neighbours full of words that stand nowhere else
        left, right = ([f"x{n}-{side}-{k}" for k in range(60)] for side in "lr")
        cut = rng.randint(0, 31)
        text = [w if k not in hidden else f"other{n}-{k}" for k, w in enumerate(item)]
        docs.append((n, " ".join(left[cut:] + text + right)))
        wanted.add(n)
    docs += [(100 + n, " ".join(rng.choice(common) for _ in range(400))) for n in range(100)]
    some = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontaminate.contaminated(some, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
    assert {r["doc_id"] for r in found.collect()} == wanted


def test_verbatim_items_of_any_length_are_found(spark):
    rng = random.Random(7)
    common = [f"c{n}" for n in range(300)]
    items = {n: " ".join([f"i{n}-{k}" if k % 3 == 0 else rng.choice(common) for k in range(n)]) for n in (*range(3, 17), 24, 33, 40, 70)}
    docs = []
    for n, item in items.items():
        for at in range(0, 33, 11):
            left, right = (" ".join(f"y{n}-{at}-{side}-{k}" for k in range(40 + at)) for side in "lr")
            docs.append((n, f"{left} {item} {right}"))
    docs += [(100 + n, " ".join(rng.choice(common) for _ in range(200))) for n in range(100)]
    some = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["cosine"] for r in decontaminate.contaminated(some, benchmark).collect()}
    assert set(found) == {(n, n) for n in items} and min(found.values()) >= 0.8  # the best passage may hold a part


def test_all_passages_make_the_space_and_are_searched(spark, monkeypatch):
    rng = random.Random(9)
    words = [f"k{n}" for n in range(60)]
    items = [(n, " ".join(rng.choice(words) for _ in range(rng.randint(5, 80)))) for n in range(12)]
    texts = [" ".join(rng.choice(words if rng.random() < 0.4 else [f"u{n}"]) for _ in range(rng.choice([1, 15, 16, 17, 33, 200]))) for n in range(60)]
    texts += [f"{texts[n]} {item} {texts[n + 1]}" for n, item in items] + ["", None]
    some = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    known = decontaminate.Vocabulary(decontaminate.words_of(benchmark))
    held = decontaminate.known_words(decontaminate.texts(some), known).cache()
    idf = np.linspace(1, 3, len(known.hashes)).astype(np.float32)
    query = decontaminate.Query(items, known, idf)
    wanted, hits = np.zeros((query.width, query.width)), set()
    for doc, text in enumerate(texts):
        own = known.places(decontaminate.Words([decontaminate.plain(text or "")]).hash)
        own = np.where(own >= 0, query.columns[own], -1)
        for lo in range(0, max(1, len(own) - 16) if len(own) else 0, 16):
            row = np.zeros(query.width)
            columns, weights = decontaminate.weighted(own[lo : lo + 32], query.idf)
            row[columns] = weights
            wanted += np.outer(row, row)
            around = own[max(0, lo - 16) : lo + 48]
            for piece, answer, item in zip(query.words, query.answer, query.item):
                lcs = decontaminate.common_subsequence(piece, around) / len(piece)
                if lcs >= 0.8 or (lcs >= 0.5 and decontaminate.common_subsequence(answer, around) >= 0.85 * len(answer)):
                    hits.add((doc, item))
    for size in (1 << 24, 7 * query.width):  # in one go, and seven rows at a time
        monkeypatch.setattr(decontaminate, "GRAM_SIZE", size)
        rows = sorted((r["bucket"], bytes(r["body"])) for part in decontaminate.passages(held, query) for r in part.collect())
        got = np.concatenate([blocks.unpack(b)[0].reshape(-1, query.width) for _, b in rows])
        assert np.abs(got - wanted).max() < 1e-4 * wanted.max()
    assert {(n + 60, n) for n, _ in items} <= hits
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(some, benchmark).collect()} == hits
    held.unpersist()


def test_frequencies_are_of_words_not_of_slots(spark):
    many = [(n, " ".join(f"z{n}-{k}-{k % 7}" for k in range(4000))) for n in range(100)]  # more words than any small table holds
    some = spark.createDataFrame([*many, (1000, "quince quince medlar")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "Quince, medlar loquat")], "item_id long, text string")
    known = decontaminate.Vocabulary(decontaminate.words_of(benchmark))
    counts, _ = decontaminate.word_frequencies(decontaminate.texts(some), known)
    names = decontaminate.Words([b"quince medlar loquat z7"]).hash
    assert counts[known.places(names[:3])].tolist() == [2, 1, 0] and known.places(names[3:]).tolist() == [-1]


def test_common_subsequence():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = rng.integers(0, 6, 20), rng.integers(0, 6, 30)
        best = np.zeros((21, 31), dtype=int)
        for i in range(20):
            for j in range(30):
                best[i + 1, j + 1] = best[i, j] + 1 if a[i] == b[j] else max(best[i, j + 1], best[i + 1, j])
        assert decontaminate.common_subsequence(a, b) == best[20, 30]


def test_toxicity(spark, docs, rows):
    rng = random.Random(4)
    marked = [(1000 + n, " ".join(rng.choice(["plain", "words", "here", "and", "there"]) for _ in range(40)) + (" zorgish you" if n % 3 == 0 else ""), int(n % 3 == 0)) for n in range(400)]
    some = spark.createDataFrame([m[:2] for m in marked], "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in marked] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(some, labels).collect()
    truth = {i: y for i, _, y in marked}
    assert len(got) == len(rows) + len(marked) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert held and sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert {r["score"] for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0}


def test_line_query_has_sql(spark):
    assert differences(spark, SF_DIR, QUERIES["op2_line_dedup"], ORACLE["op2_line_dedup"]) is None


def test_pipeline(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = corpus_pipeline.run(spark, SF_DIR)
    assert [n for n, _ in corpus_pipeline.STAGES][:2] == ["quality rules", "SimHash near-dedup"]
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and 0 < out.count()
    assert out.join(documents, "doc_id", "left_anti").count() == 0


def test_chunks_do_not_hold_a_whole_batch_twice():
    n = 4000
    part = pa.RecordBatch.from_pydict({"id": list(range(n)), "key": list(range(n)), "text": [b"x" * 5000] * n})
    tracemalloc.start()
    found = [(len(ids), sum(map(len, texts))) for ids, _, texts in blocks.chunks(iter([part]), 100_000)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(k for k, _ in found) == n and all(k == 20 for k, _ in found)
    assert peak < 5_000_000  # 20 MB before

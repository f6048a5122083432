"""The corpus operators against brute force, and on awkward tables: nulls, empty and long texts, repeated rows, clashing columns."""

import collections
import datetime
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, exact_dedup, langid, lm, minhash, quality, repeats, token_files, url_filter, words
from tidemark.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, fp long, block string, kept boolean, component string, words string, data int"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("aeioustrnlé") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 120))) for _ in range(60)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    texts += [t.upper() for t in texts[:5]] + texts[5:12]  # equal after lower-casing A-Z where there is no accent; exact copies
    texts += [texts[20] + " extra", texts[21].replace(" ", "  ", 1), passage + " one", "two " + passage, passage * 2]
    texts += [None, "", " \t\n", "x", "aaaa" * 200, "ab" * 300, "word " * 400, "é" * 120, "don't <|endoftext|> 'll 12,345 🙂   end", "Á ﬁ Σ"]
    texts.append(" ".join(rng.choice(vocabulary) for _ in range(20_000)))
    return [(i, t, ["en", "fr", None][i % 3], "s", i, "b", None, "c", "w", 1) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """A null id, and rows that repeat."""
    return spark.createDataFrame([(None, "some words here"), (1, "some words here"), (1, "some words here"), (2, None), (None, None)], "doc_id long, text string")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_exact_dedup(docs, rows, empty, odd):
    got = by_id(exact_dedup.exact_dedup(docs))
    groups = collections.defaultdict(list)
    for r in rows:
        groups[lower(r[1])].append(r[0])
    for t, ids in groups.items():
        for i in ids:
            g = got[i]
            assert (g.keep_id, g.group_size, g.kept, g.text_sha256) == (max(ids), len(ids), i == max(ids), hashlib.sha256(t.encode()).hexdigest())
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.exact_dedup(empty).count() == 0
    got = exact_dedup.exact_dedup(odd).collect()
    assert len(got) == 5 and sorted((r.keep_id, r.group_size) for r in got) == [(1, 3)] * 3 + [(2, 2)] * 2


def test_counting_quotient_filter():
    rng = np.random.default_rng(1)
    for bits in (20, 61, 64):
        a, b = (rng.integers(0, 1 << min(bits, 20), 500, dtype=np.uint64) << np.uint64(max(0, bits - 20)) for _ in range(2))
        filter_ = exact_dedup.CountingQuotientFilter
        both = filter_.load(filter_.of(a, bits=bits).merge(filter_.load(filter_.of(b, bits=bits).dump())).dump())
        want = collections.Counter(np.concatenate([a, b]).tolist())
        values, counts = both.items()
        assert dict(zip(values.tolist(), counts.tolist(), strict=True)) == want and (np.diff(values.astype(object)) > 0).all()
    assert len(filter_.load(filter_.of(np.zeros(0, np.uint64)).dump()).items()[0]) == 0


def test_round_trip(docs, rows, empty, odd):
    t = words.tokenizer(words.public_file("byte_bpe_50k.json"))
    got = by_id(bpe.round_trip(docs))
    digests = by_id(bpe.round_trip(docs, digest=True))
    for i, text, *_ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert got[i].ids == ids and got[i].decoded == t.decode(ids, skip_special_tokens=False) == (text or "")
        assert digests[i].n_tokens == len(ids) and digests[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert bpe.round_trip(empty).count() == 0
    assert sorted(len(r.ids) for r in bpe.round_trip(odd).collect()) == [0, 0, 3, 3, 3]


def test_round_trip_of_many_scripts(spark):
    """Texts of all scripts are split into words, each of which is encoded once."""
    base = "быстрая лисица 東京は 日本の首都です 🙂🙂 안녕하세요 세계 שלום עולם สวัสดี नमस्ते\u00a0दुनिया γειά\u2003σου ÀÉ x\u0007y it's 12½"
    texts = [base, f"{base}  {base}", base[::-1], " ".join(base)]
    t = words.tokenizer(words.public_file("byte_bpe_50k.json"))
    got = by_id(bpe.round_trip(spark.createDataFrame(list(enumerate(texts * 3)), "doc_id long, text string")))
    for i, text in enumerate(texts * 3):
        assert got[i].ids == t.encode(text, add_special_tokens=False).ids and got[i].decoded == text
    assert spark.createDataFrame([(base,)], "t string").select(F.size(words.byte_bpe().words(F.col("t")))).first()[0] > 25


def test_token_files(spark, docs, rows, empty, odd, tmp_path):
    t = words.tokenizer(words.public_file("word_bpe_49k.json"))
    token_files.write_shards(docs, str(tmp_path / "a"))
    got, start = by_id(token_files.read_documents(spark, str(tmp_path / "a"))), 0
    for i, text, *_ in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        assert (got[i].start, got[i].n_tokens, got[i].ids) == (start, len(ids), ids)
        start += len(ids)
    some = by_id(token_files.read_keys(spark, str(tmp_path / "a"), spark.createDataFrame([(3,), (40,), (999,), (3,)], "doc_id long")))
    assert sorted(some) == [3, 40] and some[40].ids == got[40].ids
    for most in (0, 1000):
        asked = spark.createDataFrame([(i,) for i in (*range(-5, 5000, 5), None)], "doc_id long")
        found = token_files.read_keys(spark, str(tmp_path / "a"), asked, broadcast_shards=most)
        assert {r.doc_id: r.ids for r in found.collect()} == {i: r.ids for i, r in got.items() if i % 5 == 0}
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and ("BroadcastHashJoin" in plan or not most)
    token_files.write_shards(odd, str(tmp_path / "b"), spans=2)
    assert token_files.read_keys(spark, str(tmp_path / "b"), asked.union(spark.createDataFrame([(1,)], "doc_id long"))).where("doc_id = 1").count() == odd.where("doc_id = 1").count() > 1
    assert token_files.token_files(empty).count() == 0
    assert sorted((r.start, r.n_tokens) for r in token_files.token_files(odd).collect())[-1][0] > 0 and token_files.token_files(odd).count() == 5


def test_hosts(spark):
    """Addresses stay whole, the final dot goes, a clashing column and a very long URL do no harm."""
    at = datetime.datetime(2024, 1, 5)
    urls = ["http://[2001:db8::1]:80/x", "http://10.1.2.3/", "https://u:p@Sub.Bad.example.:443/q", "http://x.ok.example/" + "a" * 100_000, "mailto:x", None]
    pages = spark.createDataFrame([(i, u, at, "clash") for i, u in enumerate(urls)], "page_id long, url string, fetched_at timestamp, domain string")
    entries = spark.createDataFrame([("l", d, datetime.datetime(2024, 1, 1), True) for d in ("2.3", "bad.example.", "[2001:db8::1]")], "list string, domain string, at timestamp, listed boolean")
    got = {r.page_id: r for r in url_filter.evaluate(pages, entries).collect()}
    assert [got[i].host for i in range(6)] == ["[2001:db8::1]", "10.1.2.3", "sub.bad.example", "x.ok.example", None, None]
    assert [got[i].blocked for i in range(6)] == [True, False, True, False, False, False] and got[2].matched_domain == "bad.example" and got[0].fetched_at == at


def test_perfect_hash():
    keys = token_files.mix64(np.arange(5000, dtype=np.uint64))
    hashed = token_files.PerfectHash.load(token_files.PerfectHash.of(keys).dump())
    assert sorted(hashed.slots(keys).tolist()) == list(range(5000))
    index = token_files._index(np.arange(100), np.full(100, 3))
    found, offset, _ = token_files.lookup(*index, token_files.keys_of(np.arange(200)))
    assert found[:100].all() and not found[100:].any() and offset[:100].tolist() == list(range(0, 300, 3))


def brute_repeats(texts, n):
    seen, out = set(), []
    for t in texts:
        t, gone = t.encode(), np.zeros(len(t.encode()) + 1, bool)
        for p in range(len(t) - n + 1):
            if t[p : p + n] in seen:
                gone[p : p + n] = True
            seen.add(t[p : p + n])
        out.append((bytes(x for x, y in zip(t, gone, strict=False) if not y), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())))
    return out


@pytest.mark.parametrize("hot", [20_000, 1])
def test_repeats(docs, rows, empty, odd, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", hot)
    got = by_id(repeats.remove_repeats(docs))
    for r, (kept, removed, spans) in zip(rows, brute_repeats([r[1] or "" for r in rows], 100), strict=True):
        assert (bytes(got[r[0]].kept), got[r[0]].n_bytes - len(got[r[0]].kept), len(got[r[0]].spans)) == (kept, removed, spans)
    assert repeats.remove_repeats(empty).count() == 0 and repeats.remove_repeats(odd, digest=True).count() == 5


def test_repeats_of_a_part_of_the_columns(spark, docs):
    """Whoever counts, selects or filters gets what whole rows have."""
    got = repeats.remove_repeats(docs, digest=True)
    whole = got.collect()
    assert got.count() == len(whole) and sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(r.doc_id for r in whole)
    assert got.where("n_removed > 0").count() == sum(r.n_removed > 0 for r in whole) and got.agg(F.sum("n_spans")).first()[0] == sum(r.n_spans for r in whole)
    assert repeats.remove_repeats(spark.createDataFrame([(1, "abc" * 200), (2, "abc" * 200)], "doc_id long, text string")).select("doc_id").count() == 2


def test_repeats_keep_nothing_in_the_heap(spark, docs):
    """What is kept between the jobs lies on disk: the blocks of a large corpus would fill the executors' heap."""

    def kept():
        return {x.id(): (x.memSize(), x.diskSize()) for x in spark.sparkContext._jsc.sc().getRDDStorageInfo()}

    before, own = kept(), docs.select((F.col("doc_id") * 7).alias("doc_id"), "text")  # no plan that is kept already
    assert repeats.remove_repeats(own, digest=True).count() == docs.count()
    new = [v for k, v in kept().items() if k not in before]
    assert new and all(memory == 0 and disk > 0 for memory, disk in new)


def test_repeats_meet_blocks_in_place(docs):
    """The blocks are dealt out once: neither cogroup moves them again."""
    plan = repeats.remove_repeats(docs, digest=True)._jdf.queryExecution().executedPlan().toString()
    left = plan[plan.index("FlatMapCoGroupsInArrow") :].split("FlatMapGroupsInArrow")[0]
    assert "InMemoryTableScan" in left[: left.index("Exchange")]


def test_equal_hashes_remove_nothing(monkeypatch):
    """Strings of a hot anchor whose hashes collide stay apart."""
    a, b = b"a" * 100, b"b" * 100
    flat, at = np.frombuffer(a + b + a, np.uint8), np.array([0, 100, 200])
    earliest = np.array([True, False, False])
    repeats._part_unequal(flat, at, earliest, 100)
    assert earliest.tolist() == [True, True, True]  # the third differs from the one before and goes on to the comparison of bytes
    earliest = np.array([True, False])
    repeats._part_unequal(flat, at[[0, 2]], earliest, 100)
    assert earliest.tolist() == [True, False]


def test_repeats_in_long_texts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "FLAT", 500)  # the driver hands them to the tasks
    monkeypatch.setattr(repeats, "SORT_BYTES", 2000)
    rng = random.Random(5)
    base = "".join(rng.choice("abcd") for _ in range(3000))
    texts = [base, base[700:2400] + "zz" + base[100:650], "q" * 1300, base[:90] + "q" * 200]
    got = by_id(repeats.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), length=60, part=20))
    assert [bytes(got[i].kept) for i in range(4)] == [x[0] for x in brute_repeats(texts, 60)]


def test_large_groups_of_equal_strings():
    """A group is split into parts that still keep one occurrence of each string only, also where hashes collide."""
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(40)) for _ in range(3)]
    texts = [texts[i % 3] + rng.choice("xyz") for i in range(60)]
    text, ends = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([len(t) for t in texts])
    kept = [b for b, _, _ in brute_repeats(texts, 40)]
    for bytes_, hashes in ((1 << 20, None), (200, None), (200, lambda flat, at, n: np.zeros(len(at), np.uint64))):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(repeats, "SORT_BYTES", bytes_)
            if hashes:
                m.setattr(repeats, "string_hashes", hashes)
            of, start, end = repeats.merged(*repeats.find_repeats(text, ends, np.arange(60), np.zeros(60, np.int64), 40))
        gone = [set() for _ in texts]
        for i, a, b in zip(of, start, end, strict=True):
            gone[i] |= set(range(a, b))
        assert [bytes(c for k, c in enumerate(t.encode()) if k not in gone[i]) for i, t in enumerate(texts)] == kept


def test_maximal_repeats():
    text = np.frombuffer(b"xabcabcyabcz", np.uint8)
    order, lcp = repeats._sorted_suffixes(text, np.arange(12), 12 - np.arange(12))
    left = np.where(order > 0, text[order - 1].astype(int), -1)
    groups = {(n, tuple(sorted(order[a : b + 1].tolist()))) for a, b, n in repeats.maximal_repeats(lcp, left, 2)}
    assert groups == {(3, (1, 4, 8))}


def test_near_dedup(docs, rows, empty, odd):
    for n in (2, 5):
        got = by_id(minhash.near_dedup(docs, n))
        sets = []
        for r in rows:
            w = WORD.findall(lower(r[1]))
            sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
        root = list(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    a, b = root[i], root[j]
                    root = [min(a, b) if x in (a, b) else x for x in root]
        for i, s in enumerate(sets):
            assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(s), root[i], root[i] == i)
    assert minhash.near_dedup(empty).count() == 0
    assert sorted(str(r.component_id) for r in minhash.near_dedup(odd).collect()) == ["1", "1", "1", "2", "None"]
    assert minhash.drop_near_copies(docs).columns == docs.columns


@pytest.mark.parametrize("small", [0, 32])
def test_near_dedup_of_many_copies(spark, small, monkeypatch):
    """Copies of one text that differ too much from each other but not all from it, and texts that share a passage: differences from
    pivots and both ways for sets far from them are used, and few pairs are left to compare."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for k in range(150):
        w = list(base)
        for at in rng.sample(range(150), rng.choice((2, 8, 14, 40))):
            w[at] = f"v{rng.randint(0, 25)}"
        texts.append(" ".join(w))
    for k in range(60):  # half of each is shared
        texts.append(" ".join([f"s{i}" for i in range(40)] + [f"own{k // 2}.{i}" for i in range(34)] + [f"end{k}.{i}" for i in range(3)]))
    open_pairs, left = minhash._open_pairs, []
    monkeypatch.setattr(minhash, "_open_pairs", lambda *args: left.append(open_pairs(*args)) or left[-1])
    got = by_id(minhash.near_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 2, small=small))
    sets = [set(zip(t.split(), t.split()[1:], strict=False)) for t in texts]
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    assert [got[i].component_id for i in range(len(sets))] == root and 1 < len(set(root)) < 150
    assert left and left[0].count() < 2000


def test_components(spark):
    links = [(i, i + 1) for i in range(20)] + [(30, 31), (31, 30), (40, 40), (None, 3), (50, 35), (35, 36)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, 30: 30, 31: 30, 35: 35, 36: 35, 50: 35}


def test_decontamination(spark, empty):
    item = "When did Anna walk 12 miles from the old town to the river and back again before noon"
    benchmark = spark.createDataFrame([(1, item), (2, "what is it"), (3, None), (4, "")], "item_id long, text string")
    docs = spark.createDataFrame(
        [
            (1, f"Some talk first. {item}. And more words after it", "x"),
            (2, "Well, When did Berta walk 30 kilometers from the old town to the river and back again before noon", "x"),  # another name, number, unit
            (3, "walk 12 miles from the old town today", "x"),
            (4, None, "x"),
            (5, "", "x"),
            (6, "What is it?", "x"),  # a short item and nothing else
            (7, "so then what is it they said", "x"),
            (None, item, "x"),
            (1, f"Some talk first. {item}. And more words after it", "x"),
        ],
        "doc_id long, text string, hash string",
    )
    rows = decontaminate.contaminated(docs, benchmark).collect()
    got = {(r.doc_id, r.item_id): r for r in rows}
    assert sorted(got) == [(1, 1), (2, 1), (6, 2)] and len(rows) == 3
    assert got[1, 1].changed_slots == 0 and got[1, 1].coverage == 1.0 and got[2, 1].changed_slots == 3
    assert sorted(str(r.doc_id) for r in decontaminate.drop_contaminated(docs, benchmark).collect()) == ["3", "4", "5", "7", "None"]
    assert decontaminate.contaminated(empty, benchmark).count() == 0 and decontaminate.contaminated(docs, benchmark.limit(0)).count() == 0


def test_decontamination_leaves_other_texts(spark):
    """Short items, bare placeholders and lists of numbers hit nothing; runs of names and numbers with separators are one slot; a long excerpt suffices."""
    numbers = " ".join(str(i) for i in range(60))
    long = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    pair = "the teacher gives Anna and Berta some red apples and then asks Anna to tell Berta how many apples are left"
    items = [(1, "Paris"), (2, "Anna"), (3, "12 miles"), (4, numbers), (5, long), (6, "how many apples does Anna buy for 12 dollars at the old market"), (7, pair)]
    docs = [
        (1, "the cat sat on the Mat with Paris and Anna"),
        (2, "walk 7 hours"),
        (3, " ".join(str(i * 7) for i in range(2000))),
        (4, "so " + " ".join(long.split()[10:40])),
        (5, "how many apples does Mary Ann buy for 1,200.50 dollars at the old market"),
        (6, "PARIS!"),
        (7, pair.replace("Anna", "Ida").replace("Berta", "Ida")),  # two names become one
        (8, pair.replace("Anna", "Ida").replace("Berta", "Eve")),
        (9, "x " * 200_000 + long),
    ]
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(4, 5), (5, 6), (6, 1), (8, 7), (9, 5)]


def test_decontamination_in_any_case(spark):
    item = "When did Anna walk 12 miles from the old straße to the river and back again before noon"
    docs = spark.createDataFrame([(1, f"SO: {item.upper()}!"), (2, item.lower()), (3, item.title()), (4, "ANNA WALKED TO A RIVER AND THEN BACK TO THE OLD TOWN BEFORE IT WAS NOON")], "doc_id long, text string")
    found = decontaminate.contaminated(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.coverage, r.changed_slots) for r in found) == [(1, 1.0, 0), (2, 1.0, 0), (3, 1.0, 0)]


def test_slots_must_agree(spark):
    item = "Otto gave Otto and Otto a book about Otto near the lake where Otto met Otto on a day like this"
    names = iter(["Ida", "Max", "Kim", "Lou", "Pam", "Sue"])
    other = re.sub("Otto", lambda _: next(names), item)
    docs = spark.createDataFrame([(1, item.replace("Otto", "Ida")), (2, other)], "doc_id long, text string")
    found = decontaminate.contaminated(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.changed_slots) for r in found] == [(1, 6)]


def test_decontamination_beyond_a_broadcast(spark, monkeypatch):
    """Repeated ids with different texts give the same rows both ways."""
    item = "On Monday Alice Brown bought 12 apples and 7 pears for 30 euros and then she walked 5 km home with her brother Tom to eat them"
    leak = "On Friday Carla Smith bought 99 apples and 3 pears for 45 euros and then she walked 8 km home with her brother Jim to eat them"
    benchmark = spark.createDataFrame([(1, item), (2, "the quick brown fox jumps over the lazy dog near the old river bank today")], "item_id long, text string")
    docs = spark.createDataFrame([(5, leak), (5, "other words " * 40), (5, None), (6, "nothing here " * 30 + leak), (6, "more of the same " * 20), (7, "clean text " * 20), (5, leak)], "doc_id long, text string")
    near = sorted(map(tuple, decontaminate.contaminated(docs, benchmark).collect()))
    assert {r[0] for r in near} == {5, 6}
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert sorted(map(tuple, decontaminate.contaminated(docs, benchmark).collect())) == near
    test_slots_must_agree(spark)


def test_stages_with_clashing_names(spark):
    schema = "doc_id long, text string, kept_id long, KEPT_ID_ string, found_id int, _kept_id int, _found_id int"
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text, 0, "", 0, 0, 0), (2, text, 1, "", 0, 0, 0), (3, text + " more", 1, "", 0, 0, 0)], schema)
    assert sorted(r.doc_id for r in exact_dedup.drop_exact_copies(docs).collect()) == [2, 3]
    assert [r.doc_id for r in minhash.drop_near_copies(docs).collect()] == [1]
    assert decontaminate.drop_contaminated(docs, spark.createDataFrame([(1, text)], "item_id long, text string")).count() == 0


def test_language_by_brute_force(spark):
    """The network's answer for whole texts, position by position and filter by filter."""
    rng = np.random.default_rng(4)
    names, width = ["aa", "bb", "cc"], {f: 2 + f // langid.FILTERS for f in range(3 * langid.FILTERS)}
    shape = (langid.WIDEST * langid.EMBED, len(width))
    net = langid.Network(names, rng.normal(size=(257, langid.EMBED)).astype(np.float32), (rng.normal(size=shape) * langid._mask()).astype(np.float32), rng.normal(size=len(width)).astype(np.float32), rng.normal(size=(len(width), 3)).astype(np.float32), rng.normal(size=3).astype(np.float32))
    texts = ["abc", "é" * 40 + " word", "some longer text " * 40, "x" * 256, "y" * 257]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), net).collect()}
    for i, t in enumerate(texts):
        raw, logits = list(t.encode()), []
        for at in range(0, len(raw), langid.WINDOW):
            codes = raw[at : at + langid.WINDOW]
            codes += [256] * (langid.WINDOW + langid.WIDEST - 1 - len(codes))
            hidden = []
            for f, w in width.items():
                best = max(sum(float(net.embed[codes[p + k]].astype(float) @ net.conv[k * langid.EMBED : (k + 1) * langid.EMBED, f]) for k in range(w)) for p in range(langid.WINDOW))
                hidden.append(max(0.0, best + float(net.bias[f])))
            logits.append(np.array(hidden) @ net.out + net.out_bias)
        z = np.mean(logits, axis=0)
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert got[i].lang_pred == names[int(p.argmax())] and abs(got[i].score - p.max()) < 1e-4


def test_training_windows(spark):
    """A language is learned from any part of a text, and from one row of an id."""
    noise = "zz qq " * 100
    rows = [(i, noise + ("der und die " if i % 2 else "the and of ") * 120 + noise, "de" if i % 2 else "en") for i in range(60)]
    table = spark.createDataFrame(rows + rows[:5], "doc_id long, text string, lang string")
    net = langid.train(table, each=4)
    got = langid.identify(spark.createDataFrame([(1, "der und die " * 30), (2, "the and of " * 30)], "doc_id long, text string"), net)
    assert {r.doc_id: r.lang_pred for r in got.collect()} == {1: "de", 2: "en"}


def test_quality(spark, docs, empty, odd):
    rng = random.Random(4)
    good = [" ".join(rng.choice("sun moon tree house water stone bird cloud path hill".split()) for _ in range(40)) for _ in range(60)]
    texts = good + [t + " vile" for t in good] + [t.upper().replace(" ", "!! ") for t in good]
    grades = [2] * 60 + [0] * 60 + [1] * 60
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, g) for i, g in enumerate(grades) if i % 3] + [(None, 1), (5, None), (6, 3), (9, -1)], "doc_id long, grade int")
    model = quality.train(table, labels, 3)
    assert (np.diff(model.thresholds) >= 0).all()
    got = by_id(quality.classify(table, model, 2))
    held = [i for i in range(180) if i % 3 == 0]
    assert sum(got[i].selected == (grades[i] == 2) for i in held) >= 0.95 * len(held)
    means = [np.mean([got[i].expected_grade for i in held if grades[i] == g]) for g in range(3)]
    assert means[0] < means[1] < means[2]
    assert quality.classify(odd, model, 2).count() == 5
    assert quality.select(empty, model, 2).count() == 0 and quality.select(empty, model, 2).columns == docs.columns
    for awkward in (docs, odd, table.selectExpr("*", "1 AS selected", "2 AS tail_probability", "text AS words")):  # nulls, empty and long texts, repeats, names in use
        kept, chosen = quality.select(awkward, model, 2), [r.doc_id for r in quality.classify(awkward, model, 2).collect() if r.selected]
        assert kept.columns == awkward.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, chosen))
    assert quality.classify(empty, model, 2).count() == 0 and quality.train(empty, labels, 3).thresholds.shape == (2,)


def test_language(spark, empty):
    rng = random.Random(8)
    letters = {"aa": "abcdefg", "bb": "opqrstu"}
    table = [(i, " ".join("".join(rng.choice(letters[k]) for _ in range(5)) for _ in range(60)), k) for i, k in enumerate(["aa", "bb"] * 100)]
    table += [(500, None, "aa"), (501, "", None), (502, "123 !!", "bb"), (503, "abc cba fed", None), (504, "opq " * 3000, "bb")]
    got = by_id(langid.languages(spark.createDataFrame(table, "doc_id long, text string, lang string")))
    held = [r for r in table[:200] if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert np.mean([got[i].lang_pred == k for i, _, k in held]) > 0.9 and all(got[i].held_out for i, _, _ in held)
    assert [got[i].lang_pred for i in (500, 501, 502, 504)] == ["und", "und", "und", "bb"] and all(0 <= r.score <= 1 for r in got.values())
    assert langid.languages(empty).count() == 0
    clash = spark.createDataFrame([(*r, "x", 2.0, True) for r in table + table[:7]], "doc_id long, text string, lang string, lang_pred string, score double, held_out boolean")
    more = langid.languages(clash).collect()
    assert len(more) == len(table) + 7 and len({tuple(r) for r in more}) == len(table) and more[0].lang_pred != "x"
    assert langid.identify(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), None).first().lang_pred == "und"


def test_language_model(docs, rows, empty, odd):
    got = by_id(lm.score_texts(docs))
    tokens = {r[0]: [*WORD.findall(lower(r[1])), None] for r in rows}
    counts = collections.Counter()
    for i, t in tokens.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(t)
    n, v = sum(counts.values()), len(counts)
    for i, t in tokens.items():
        r, base = got[i], sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(i).encode()) % 5 == 1, len(t), sum(counts[x] > 0 for x in t), n)
        assert abs(base - r.base_score) < 1e-6 * abs(base) and r.score < 0
    assert lm.score_texts(empty).count() == 0 and lm.score_texts(odd).count() == 5


def test_language_model_learns_from_every_text(spark):
    """What only texts beyond any first 1,500 by hash hold is learned as well, and its words have outputs of their own."""
    table = spark.range(3000).withColumn("held", F.crc32(F.col("id").cast("string")) % 5 == 1)
    first = {r.id for r in table.where("NOT held").orderBy(F.xxhash64("id"), "id").limit(1500).collect()}
    rng = random.Random(6)
    texts = [(r.id, " ".join(rng.choice(["red", "green", "blue", "grey"]) for _ in range(16)) if r.id in first else "zig zag " * 8) for r in table.collect()]
    got = by_id(lm.score_texts(spark.createDataFrame(texts, "doc_id long, text string").repartition(3)))
    held = [got[i] for i, t in texts if "zig" in t and got[i].held_out]
    assert len(held) > 500 and all(r.score > r.base_score + 0.2 * r.n_tokens for r in held)


def test_language_model_is_normalised():
    rng = np.random.default_rng(2)
    stream = rng.integers(0, 40, 5000)
    stream[1::2] = (stream[::2] + 1) % 40  # every second output follows from the one before
    prior = np.bincount(stream, minlength=40) / len(stream)
    context, output, bias, normal = lm.fit(np.concatenate([[0], stream[:-1]]), stream, prior, epochs=6)
    p = np.exp(context @ output.T + bias - normal[:, None])
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)
    assert np.mean(np.log(p[stream[:-1], stream[1:]])) > np.mean(np.log(prior[stream[1:]])) + 0.1


def test_url_filter(spark):
    entries = [("spam", "Bad.example", 10, True), ("spam", "bad.example", 20, False), ("adult", "x.bad.example", 5, True), ("spam", "bad.example", 12, True), ("spam", None, 1, True), ("malware", "late.example", 30, True), ("malware", "late.example", 30, False)]
    captures = [(1, "http://x.bad.example/a?b", 15), (2, "https://BAD.example:80", 9), (3, "https://u@bad.example/", 20), (4, None, 15), (5, "no url", 15), (6, "http://x.bad.example/", 25), (7, "http://bad.example", None), (8, "http://late.example", 40), (1, "http://x.bad.example/a?b", 15)]
    got = {r.page_id: r for r in url_filter.evaluate(spark.createDataFrame(captures, "page_id long, url string, fetched_at long"), spark.createDataFrame(entries, "list string, domain string, at long, listed boolean")).collect()}
    assert {i: (r.blocked, r.matched_domain, r.lists) for i, r in got.items()} == {
        1: (True, "x.bad.example", "adult,spam"), 2: (False, None, None), 3: (False, None, None), 4: (False, None, None), 5: (False, None, None),
        6: (True, "x.bad.example", "adult"), 7: (False, None, None), 8: (False, None, None),
    }
    long = "http://" + "a." * 40 + "bad.example/" + "b" * 300_000
    clash = spark.createDataFrame([(None, long, 15, "h", "l", True), (9, "http://x/" + "/" * 300_000, 15, "h", "l", True), (9, "", 15, "h", "l", True)], "page_id long, url string, fetched_at long, host string, list string, blocked boolean")
    rows = url_filter.evaluate(clash, spark.createDataFrame(entries, "list string, domain string, at long, listed boolean").selectExpr("*", "1 AS url", "2 AS valid_from")).collect()
    assert sorted((str(r.page_id), r.blocked, str(r.matched_domain)) for r in rows) == [("9", False, "None"), ("9", False, "None"), ("None", True, "bad.example")]
    empty = spark.createDataFrame([], "page_id long, url string, fetched_at long")
    assert url_filter.evaluate(empty, spark.createDataFrame([], "list string, domain string, at long, listed boolean")).count() == 0


def test_words_in_runs():
    odd = ["<|endoftext|>x", "a<|startoftext|>b", "", "İstanbul", "ΣΑΣ", "é", "'s", "xy", "don't", "!!'s", "1234", "ﬁ", "🙂x", "½²", "a</w>b", "\x00", "ÀÉ,"]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        path = words.public_file(name)
        ids, lengths = words.encode_flat(path, pa.array(odd * 40))
        ends = np.cumsum(lengths)
        assert all(ids[b - n : b].tolist() == words.tokenizer(path).encode(w, add_special_tokens=False).ids for w, b, n in zip(odd * 40, ends, lengths, strict=True))


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    source = spark.read.parquet(str(tmp_path / "documents.parquet"))
    texts = {r.doc_id: r.text for r in source.collect()}
    items = [r.text for r in spark.read.parquet(str(tmp_path / "benchmark.parquet")).collect()]
    kept = [r.doc_id for r in out.collect()]
    assert 0 < len(kept) == len(set(kept)) < len(texts)
    assert len({lower(texts[i]) for i in kept}) == len(kept)  # no exact copies
    assert not [i for i in kept for t in items if t in texts[i]]  # no leaks
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i in kept if (w := WORD.findall(lower(texts[i])))}
    assert not [(i, j) for i in sets for j in sets if i < j and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])]
    docs = source
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns and after.exceptAll(docs).count() == 0
        docs = after


def test_stages_on_awkward_tables(spark, docs, rows, empty, odd, tmp_path):
    """Nulls in any column, repeated rows, clashing names, an empty table: a defined result for every stage."""
    import corpus_pipeline

    labels = [(r[0], float(r[0] % 2) if r[0] % 3 else None, None if r[0] % 7 == 0 else 0) for r in rows] + [(None, 1.0, 0), (3, 1.0, 1), (3, 5.0, 0), (4, -9.0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality double, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    items = [(1, rows[30][1]), (None, None), (2, ""), (2, None), (1, rows[30][1])]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    twice = docs.unionByName(docs.where("doc_id < 3"))  # rows that repeat
    for stage in list(stages.values())[:-1]:
        assert stage(spark, empty, str(tmp_path)).count() == 0
        after = stage(spark, twice, str(tmp_path))
        assert after.columns == docs.columns and after.exceptAll(twice).count() == 0
    assert stages["BPE encoding and decoding"](spark, empty, str(tmp_path)).count() == 0
    kept = lambda name, table: sorted(str(r.doc_id) for r in stages[name](spark, table, str(tmp_path)).collect())
    last = {lower(r[1]): r[0] for r in rows}  # the largest id of each text
    assert kept("exact dedup", twice) == sorted(str(i) for i in [*last.values(), *[i for i in range(3) if i in last.values()]])
    assert kept("exact dedup", odd) == ["1", "1", "2"]
    assert kept("MinHash near-dedup", odd) == ["1", "1", "2", "None", "None"]
    assert kept("benchmark decontamination", odd) == ["1", "1", "2", "None", "None"]
    assert kept("benchmark decontamination", twice) == sorted(str(r[0]) for r in [*rows, *rows[:3]] if (rows[30][1] or "\0") not in (r[1] or ""))
    assert kept("quality classifier", odd) in ([], ["1", "1", "None"], ["2", "None"], ["1", "1", "2", "None", "None"])  # equal texts alike

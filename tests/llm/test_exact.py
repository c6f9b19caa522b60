"""Operators whose rows follow from a definition, against brute force on awkward tables."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cartloom.llm import decontaminate, fingerprint, lmscore, minhash, mixture, recompress, suffixes
from tests.llm.fixtures import by_id, documents, prose, texts

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def removed_bytes(rows, window=50):
    first, out = {}, {}
    for i, text, _ in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        cut = bytearray(len(raw))
        for s in range(len(raw) - window + 1):
            owner = first.setdefault(raw[s : s + window], i)
            if owner < i:
                cut[s : s + window] = b"\1" * window
        kept = bytes(b for b, c in zip(raw, cut) if not c)
        spans = sum(1 for k in range(len(cut)) if cut[k] and (k == 0 or not cut[k - 1]))
        out[i] = (len(raw), sum(cut), spans, hashlib.sha256(kept).hexdigest())
    return out


def removed_words(rows, window=20):
    seen, out = set(), {}
    for i, text, _ in sorted(rows, key=lambda r: r[0]):
        words = spaced(text)
        cut = [0] * len(words)
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            if key in seen:
                cut[s : s + window] = [1] * window
            seen.add(key)
        kept = " ".join(w for w, c in zip(words, cut) if not c)
        out[i] = (len(words), sum(cut), hashlib.sha256(kept.encode()).hexdigest())
    return out


def near_groups(rows):
    sets = {}
    for i, text, _ in rows:
        w = spaced((text or "").translate(FOLD))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    group = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                common, total = len(sets[a] & sets[b]), len(sets[a] | sets[b])
                if a != b and total and 100 * common >= 75 * total and group[a] > group[b]:
                    group[a], changed = group[b], True
    return {i: (len(sets[i]), group[i]) for i in sets}


@pytest.mark.parametrize("unit_bytes", [4 << 20, 3000])
def test_suffix_dedup_matches_brute_force(spark, unit_bytes):
    got = by_id(suffixes.remove_repeated_bytes(documents(spark, extra="n_bytes other"), unit_bytes=unit_bytes, bucket_bytes=5000))
    want = removed_bytes(texts())
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == want
    assert all(r["other"] == "kept" for r in got.values())


def test_suffix_dedup_rewrites_text(spark):
    got = by_id(suffixes.remove_repeated_bytes(documents(spark), rewrite=True))
    assert got[30]["text"] is None and got[31]["text"] == "" and got[7]["text"] == "" and got[3]["text"] == prose(120, 1)


@pytest.mark.parametrize("unit_bytes", [4 << 20, 3000])
def test_substring_dedup_matches_brute_force(spark, unit_bytes):
    got = by_id(recompress.remove_repeated_words(documents(spark, extra="n_words"), unit_bytes=unit_bytes, bucket_bytes=5000))
    assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in got.items()} == removed_words(texts())


def test_repeat_removers_on_few_symbols(spark):
    """Long runs and very short alphabets: the windows' anchors must still agree."""
    import random

    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.choice([15, 25, 90]))), "s") for i in range(60)]
    rows += [(100 + i, "a " * rng.randint(10, 70), "s") for i in range(20)]
    got = by_id(recompress.remove_repeated_words(documents(spark, rows)))
    assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in got.items()} == removed_words(rows)
    got = by_id(suffixes.remove_repeated_bytes(documents(spark, rows)))
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == removed_bytes(rows)


def test_rows_with_one_id_do_not_remove_each_other(spark):
    text = prose(80, 1)
    rows = [(5, text, "a"), (5, text, "a"), (None, text, "a"), (6, text, "a")]
    got = suffixes.remove_repeated_bytes(documents(spark, rows)).collect()
    assert sorted((r["doc_id"] or -1, r["n_removed"] > 0) for r in got) == [(-1, False), (5, True), (5, True), (6, True)]


@pytest.mark.parametrize("block", [1024, 2])
def test_minhash_matches_brute_force(spark, block):
    rows = texts() + [(200 + k, " ".join(prose(120, 1).split()[k:] + prose(k * 2, 50 + k).split()), "z") for k in range(1, 12)]
    got = by_id(minhash.near_duplicates(documents(spark, rows, "n_shingles kept"), block=block))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == near_groups(rows)
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def test_minhash_links_a_family_that_only_shares_its_original(spark):
    """Copies that are near the original but not near each other."""
    words = prose(200, 4).split()
    rows = [(1000, " ".join(words), "a")]
    for k in range(40):
        copy = list(words)
        for j in range(3):
            copy[(k * 5 + j * 67) % 200] = f"edit{k}{j}"
        rows.append((1 + k, " ".join(copy), "a"))
    got = by_id(minhash.near_duplicates(documents(spark, rows)))
    assert {i: r["component_id"] for i, r in got.items()} == {i: g for i, (_, g) in near_groups(rows).items()}


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["component"] for r in minhash.components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def benchmark_rows():
    words = prose(60, 2).split()
    return [("i1", " ".join(words[5:30])), ("i2", "Two   WORDS!"), ("i3", None), ("i4", ""), ("i5", " ".join(words[20:30])), ("i5", "cat-sat"), (None, "one")]


def test_decontamination_matches_brute_force(spark):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(FOLD))
    windows = defaultdict(set)
    for item, text in benchmark_rows():
        w = split(text)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(item or "")
    want = {}
    for i, text, _ in texts():
        w, hit, items = split(text), set(), set()
        for pattern, ids in windows.items():
            for k in range(len(w) - len(pattern) + 1):
                if tuple(w[k : k + len(pattern)]) == pattern:
                    hit.update(range(k, k + len(pattern)))
                    items |= ids
        want[i] = (len(w), sorted(hit), sorted(items))
    bench = spark.createDataFrame(benchmark_rows(), "item_id string, text string")
    for block_bytes in (1 << 20, 30):
        got = by_id(decontaminate.find_benchmark_words(documents(spark, extra="n_words"), bench, block_bytes=block_bytes))
        assert {i: (r["n_words"], list(r["hit_words"]), list(r["hit_items"])) for i, r in got.items()} == want
    assert by_id(decontaminate.find_benchmark_words(documents(spark), bench.limit(0)))[62]["n_words"] == 10


def test_mix_follows_targets(spark):
    rows = [(i, prose(5 + i % 40, i), f"s{i % 4}" if i % 3 else "hot") for i in range(900)] + [(9000, None, "empty"), (9001, "a b", None)]
    docs = documents(spark, rows)
    plan = mixture.plan_mix(docs).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in plan:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
        assert 0 <= r["copies"] <= 3
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    for s in sizes:
        assert target[s] <= 3 * sizes[s] + 1e-9 and abs(taken[s] - target[s]) <= 45, s
    assert sorted(map(tuple, plan)) == sorted(map(tuple, mixture.plan_mix(docs.repartition(7)).collect()))
    mixed = mixture.mix_sources(docs.withColumn("copies", F.lit("x")))
    assert mixed.columns == ["doc_id", "text", "source", "copies"]
    count = defaultdict(int)
    for r in mixed.collect():
        count[r["doc_id"]] += 1
    assert count == {r["doc_id"]: r["copies"] for r in plan if r["copies"]}


def test_mix_of_repeated_rows(spark):
    rows = [(1, "a b c", "x")] * 5 + [(2, "d e", "y"), (None, "f", "y")]
    plan = mixture.plan_mix(documents(spark, rows)).collect()
    assert mixture.mix_sources(documents(spark, rows)).count() == sum(r["copies"] for r in plan)


def test_fingerprints(spark):
    got = by_id(fingerprint.fingerprint_documents(documents(spark, extra="fingerprint")))
    rows = sorted(texts(), key=lambda r: -r[0])
    for (i, text, _), (_, after, _) in zip(rows, rows[1:] + rows[:1]):
        text, after = text or "", after or ""
        cut = len(text) // 3
        changed = text[: len(text) - cut] + after[:cut]
        assert got[i]["n_chars"] == len(text) and got[i]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
    assert got[3]["fingerprint"] == got[7]["fingerprint"] != got[12]["fingerprint"]
    assert got[31]["near_next"] == 1.0 and got[30]["fingerprint"] == ""
    assert 0.55 < got[51]["near_edited"] < 0.75 and got[20]["near_next"] == 0


def test_fingerprint_likeness_survives_a_shift():
    text = prose(600, 3).encode()
    a, b, c = fingerprint.fingerprints([text, b"some new words in front " + text, prose(600, 4).encode()])
    assert a.likeness(b) > 0.9 and a.likeness(c) < 0.05 and a.likeness(a) == 1


def test_lm_base_scores(spark):
    import math
    import zlib
    from collections import Counter

    got = by_id(lmscore.score_documents(documents(spark, extra="score")))
    tokens = {i: spaced((t or "").translate(FOLD)) + [None] for i, t, _ in texts()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    count = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    for i, ws in tokens.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(ws), sum(count[w] > 0 for w in ws), n, held[i])
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws))
        assert r["score"] < 0


@pytest.mark.parametrize("run", [
    suffixes.remove_repeated_bytes, recompress.remove_repeated_words, minhash.near_duplicates, mixture.plan_mix, mixture.mix_sources,
    fingerprint.fingerprint_documents, lmscore.score_documents,
])
def test_empty_and_null_tables(spark, run):
    assert run(documents(spark, []).coalesce(1)).collect() == []
    rows = run(documents(spark, [(None, None, None), (None, None, None)])).collect()
    assert len(rows) in (0, 2)

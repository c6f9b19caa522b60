"""What one MinHash block hands on: links of a forest, and nothing for families below the threshold."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from cartloom.llm import common as C
from cartloom.llm import minhash


def family(members, shared, own, seed):
    """Sets of ``shared`` common and ``own`` own codes, as rows of one block in which every band is shared."""
    base = C.seeded(shared, seed)
    rows = []
    for k in range(members):
        codes = np.unique(np.concatenate([base, C.seeded(own, seed + 1000 + k)]))
        sig = (minhash.signature(codes) >> np.uint32(16)).astype(np.uint16).tobytes()
        rows.append({"node": seed * 100_000 + k, "sig": sig, "codes": codes.tobytes(), "bands": list(range(minhash.BANDS))})
    return rows


def block(rows, band=0):
    pdf = pd.DataFrame(rows)
    return pdf.assign(component=pdf["node"], band=band, own=0, row=0, col=0)


@pytest.mark.parametrize("members", [100, 400])
def test_families_below_the_threshold_hand_on_nothing(members):
    assert minhash.block_links(block(family(members, 300, 100, 1)), 75) == []  # similarity 0.6


def test_linked_families_hand_on_a_forest():
    rows = family(150, 300, 30, 2) + family(90, 300, 30, 3) + family(40, 300, 100, 4)
    links = minhash.block_links(block(rows), 75)
    assert len(links) == 149 + 89
    part = {r["node"]: r["node"] for r in rows}
    for a, b in links:
        old, new = part[b], part[a]
        part = {k: new if v == old else v for k, v in part.items()}
    assert len(set(part.values())) == 2 + 40


def test_pairs_are_compared_in_their_first_band_only():
    rows = family(20, 300, 30, 5)
    assert len(minhash.block_links(block(rows, 0), 75)) == 19 and minhash.block_links(block(rows, 3), 75) == []


def test_the_threshold_is_exact():
    common = C.seeded(300, 9)
    for own, linked in ((100, True), (101, False)):  # 300 of 400, 300 of 401
        rows = family(1, 300, 0, 9) + family(1, 300, 0, 9)
        rows[1] = {**rows[1], "node": 7, "codes": np.unique(np.concatenate([common, C.seeded(own, 77)])).tobytes()}
        assert bool(minhash.block_links(block(rows), 75)) == linked


def test_long_words_that_defeat_polynomials_are_told_apart(spark):
    from cartloom.llm import recompress
    from tests.llm.fixtures import by_id, documents, prose

    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    shared = prose(19, 3)
    rows = [(1, f"{shared} {a}", "s"), (2, f"{shared} {b}", "s"), (3, f"{shared} {a}", "s")]
    data, offsets = C.buffers(pa.array([a, b, a]))
    codes = C.word_codes(data, offsets, C.SPACED, C.SAME)[0]
    assert codes[0] != codes[1] and codes[0] == codes[2]
    removed = by_id(recompress.remove_repeated_words(documents(spark, rows)))
    assert [removed[k]["n_removed"] for k in (1, 2, 3)] == [0, 0, 20]
    near = by_id(minhash.near_duplicates(documents(spark, [(1, a, "s"), (2, b, "s"), (3, a, "s")])))
    assert [near[k]["component_id"] for k in (1, 2, 3)] == [1, 2, 1]


def test_long_words_of_a_benchmark_are_found(spark):
    from cartloom.llm import decontaminate
    from tests.llm.fixtures import by_id, documents, prose

    long = "Ab" * 400
    item = f"{prose(4, 1)} {long} {prose(7, 2)}"
    bench = spark.createDataFrame([("i1", item), ("i2", "x" * 300), ("i3", "")], "item_id string, text string")
    rows = [(1, f"{prose(3, 8)} {item.upper()} {prose(3, 9)}", "s"), (2, item.replace("Ab", "Ac"), "s"), (3, "X" * 300, "s"), (4, "x" * 301, "s")]
    found = by_id(decontaminate.find_benchmark_words(documents(spark, rows), bench))
    assert [(len(found[k]["hit_words"]), found[k]["hit_items"]) for k in (1, 2, 3, 4)] == [(12, ["i1"]), (0, []), (1, ["i2"]), (0, [])]


def test_a_megabyte_of_benchmark_compiles_in_seconds():
    import time

    from cartloom.llm import decontaminate
    from tests.llm.fixtures import prose

    rows = [(str(k), prose(500, k)) for k in range(250)]
    start = time.process_time()
    tables = decontaminate.compile_block(rows, 10)
    assert sum(len(t.texts) for t in tables) > 100_000 and time.process_time() - start < 10

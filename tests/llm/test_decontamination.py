"""Templates that many items share, excerpts of a chosen length, sections and blocks of the decontamination."""

import random
import time
import tracemalloc

import pytest

from sparkraster.llm import decontaminate


def distance(p, t):
    """Least edit distance of ``p`` and a region of ``t``."""
    row = [0] * (len(t) + 1)
    for i, a in enumerate(p, 1):
        new = [i]
        for j, b in enumerate(t, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def cut_up(items, shortest=decontaminate.SHORTEST):
    return [(i, p, w) for i, t in items for p, w in decontaminate.windows_of(decontaminate.normal(t), shortest)]


HEAD = "the following question has exactly one answer: "


def test_an_opening_of_thousands_of_items_is_cheap():
    rnd = random.Random(1)
    items = [(i, HEAD + "".join(rnd.choice("abcdefghij klmnop") for _ in range(60))) for i in range(5700)]
    m = decontaminate.Matcher(cut_up(items))
    text = HEAD * 31
    tracemalloc.start()
    assert m.find(text) == [] and tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()
    began = time.process_time()
    assert m.find(text) == []
    assert time.process_time() - began < 3  # 21 s where every window is aligned by itself
    hit = m.find(text + items[77][1] + " and " + text)
    assert {m.every[w][0] for w, *_ in hit} == {77} and {cost for *_, cost in hit} == {0}


@pytest.mark.parametrize("held", [(1 << 16, 1 << 17, 1 << 14, 64), (1 << 16, 1 << 17, 1 << 14, 1), (53, 5, 3, 2)])
def test_shared_beginnings_equal_full_alignment(monkeypatch, held):
    for name, n in zip(("SECTION", "ENTRIES", "ACTIVE", "FEW"), held):
        monkeypatch.setattr(decontaminate, name, n)
    rnd = random.Random(7)
    for alphabet in ("ab ", "abcde ", "abcdefghijklmnop "):
        heads = ["".join(rnd.choice(alphabet) for _ in range(n)) for n in (0, 25, 50)]
        items = [(i, rnd.choice(heads) + "".join(rnd.choice(alphabet) for _ in range(rnd.choice([9, 20, 45, 100])))) for i in range(9)]
        windows = cut_up(items + [(99, items[0][1])])
        m = decontaminate.Matcher(windows)
        for _ in range(8):
            text = ""
            for _ in range(rnd.randrange(1, 4)):
                part = list(rnd.choice(windows)[2])
                for _ in range(rnd.randrange(8)):
                    at = rnd.randrange(len(part) + 1)
                    part[at : at + rnd.randrange(2)] = rnd.choice(["", "x", "yz"])
                text += "".join(part) + rnd.choice(["", " kk" * 9])
            text = decontaminate.normal(text)
            if not text:
                continue
            near = {(i, d) for i, (_, _, p) in enumerate(windows) if len(p) >= m.q and (d := distance(p, text)) <= m.k[i]}
            assert {(w, cost) for w, _, _, cost in m.find(text) if len(m.every[w][2]) >= m.q} == near


def test_edits_follow_one_formula():
    for length in range(8, 130):
        k = decontaminate.edits(length)
        assert k == min(int(0.08 * length), length // 8 - 1) and length - 8 + 1 - 8 * k >= 1
    item = "abcdefghijklmnopqrstuvwxyz0123456789-+?"  # 39 characters
    for n in (39, 38, 30, 26):
        m = decontaminate.Matcher(cut_up([(1, item[:n])]))
        assert m.find("zz qq " + item[: n // 2] + "#" + item[n // 2 + 1 : n] + " yy")
        assert not m.find("zz qq " + item[: n // 2 - 4] + "########" + item[n // 2 + 4 : n] + " yy")


@pytest.mark.parametrize("shortest", [24, 40, 69, 100])
def test_excerpts_of_the_shortest_length_are_found_at_all_offsets(shortest):
    rnd = random.Random(4)
    item = decontaminate.normal("".join(rnd.choice("abcdefghijkl mnop") for _ in range(210)))
    m = decontaminate.Matcher(cut_up([(1, item)], shortest))
    for at in range(len(item) - shortest + 1):
        assert m.find(f"Zz qq#{item[at : at + shortest]}#yy"), at


def test_blocks_give_one_result(spark):
    rnd = random.Random(5)
    items = [(i, HEAD + "".join(rnd.choice("abcdefgh ij") for _ in range(90))) for i in range(4)] + [(None, "a b"), (9, "same " * 20), (10, "same " * 20)]
    docs = [(i, f"before {t} after") for i, t in items] + [(70, HEAD * 9), (71, "same " * 40), (72, None), (73, ""), (74, "b a b c")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(map(str, decontaminate.leaks(d, b).collect()))
    left = sorted(map(str, decontaminate.clean(d, b).collect()))
    assert len(left) == 3 and "doc_id=70" in " ".join(left)
    for size in (30,):
        assert sorted(map(str, decontaminate.leaks(d, b, size=size).collect())) == want
        assert sorted(map(str, decontaminate.clean(d, b, size=size).collect())) == left

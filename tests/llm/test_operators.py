"""Operators on hand-made rows: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from crewcast.llm import components, decontaminate, exact_dedup, html_text, language_id, near_dedup, packing, quality, samples, secrets, sharding, texts, toxicity

WORDS = [a + b for a in "ba de fi go lu".split() for b in "ran sel tik mon pur wex".split()]
SCHEMA = "doc_id long, text string, id string, hash int, row int"


def sentence(seed: int, count: int) -> str:
    return " ".join(random.Random(seed).choices(WORDS, k=count))


def odd_rows() -> list[tuple]:
    """Null id, null and empty text, a repeated row, one id with two texts, a very long text; columns named like inner ones."""
    long_text = sentence(1, 30_000)
    return [(1, None, "x", 1, 1), (2, "", "x", 1, 1), (3, long_text, None, None, None), (4, long_text, "y", 2, 2), (5, "one two", "z", 3, 3),
            (5, "one two", "z", 3, 3), (6, "one two", "z", 4, 3), (None, "one two", "z", 5, 3), (7, " \n\t ", "z", 5, 3), (8, sentence(2, 60), "z", 5, 3),
            (8, sentence(3, 60), "z", 5, 3), (None, None, "z", 5, 3)]


@pytest.fixture
def odd(frame):
    return frame(odd_rows(), SCHEMA)


@pytest.fixture
def nothing(frame):
    return frame([], SCHEMA)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_copies(odd, nothing, keep):
    groups = {}
    for r in odd_rows():
        groups.setdefault(r[1] or "", []).append(r[0])
    rows = exact_dedup.label_copies(odd, keep=keep).collect()
    assert len(rows) == len(odd_rows())
    pick = min if keep == "smallest" else max
    for r in rows:
        ids = groups[r["row"]["text"] or ""]
        assert r["group_size"] == len(ids) and r["keep_id"] == pick(i for i in ids if i is not None)
    assert Counter(r["row"]["text"] or "" for r in rows if r["kept"]) == Counter(set(groups))
    left = exact_dedup.drop_copies(odd)
    assert left.columns == odd.columns and left.count() == len(groups)
    assert exact_dedup.label_copies(nothing).collect() == []


def test_a_hot_text_is_split_and_joined_again(frame):
    rows = [(i, "hot" if i % 2 else f"text {i // 4}", "x", 1, 1) for i in range(1000)]
    found = exact_dedup.label_copies(frame(rows, SCHEMA)).collect()
    sizes = Counter(r[1] for r in rows)
    first = {}
    for r in rows:
        first.setdefault(r[1], r[0])
    assert all(r["group_size"] == sizes[r["row"]["text"]] and r["keep_id"] == first[r["row"]["text"]] for r in found)
    assert all(r["kept"] == (r["keep_id"] == r["row"]["doc_id"]) for r in found)


def test_shards(odd, nothing, frame):
    rows = sharding.assign(odd, [1.0] * 5).collect()
    assert len(rows) == len(odd_rows())
    for shard in range(5):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    assert all(r["grown_shard"] in (r["shard"], 5) for r in rows)
    assert sharding.assign(nothing, [1.0] * 5).collect() == []
    many = frame([(i, "x", "x", 1, 1) for i in range(4000)], SCHEMA)
    few, more = ({r["doc_id"]: r["shard"] for r in sharding.assign(many, w).collect()} for w in ([1.0, 2.0, 0.0, 1.0], [1.0, 2.0, 0.0, 1.0, 1.0]))
    share = Counter(few.values())
    assert share[2] == 0 and 1800 < share[1] < 2200
    assert all(more[k] in (few[k], 4) for k in few)


def test_more_slices_keep_slots_gapless(frame, monkeypatch):
    monkeypatch.setattr(sharding, "SLICE_ROWS", 3)
    rows = sharding.assign(frame([(i, "x", "x", 1, 1) for i in range(300)], SCHEMA), [1.0] * 3).collect()
    for shard in range(3):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))


def plain_spans(text: str, rule: secrets.Rule) -> list[tuple[int, int]]:
    return [m.span() for m in re.finditer(rule.pattern, text, re.ASCII) if len(m.group(rule.group)) >= rule.least]


SECRETS = [
    "", "no secret here", 'password = "abcdefgh1" and PASSWD:\'short\'', "é token=abcdefghij token: token:abcdefghij", "AKIA" + "Z" * 12 + " AKIAX",
    "x" + "0f" * 20 + "é" + "0f" * 15, "api_key=" + "k" * 9 + "\nApiKey: " + "k" * 7, "ghp_" + "a" * 36, "-----BEGIN RSA PRIVATE KEY-----",
    "eyJhbGciOi.eyJzdWIi.c2ln xoxb-1234567890", "secret=" + "a" * 50_000, "deadbeef" * 4 + "AKIA" + "A" * 16, "🔑 token=12345678",
]


def test_secret_spans(frame, odd, nothing):
    docs = frame([(i, t, "x", 1, 1) for i, t in enumerate(SECRETS)], SCHEMA)
    found = secrets.scan(docs).collect()
    assert len(found) == len(SECRETS)
    for row in found:
        for rule in secrets.RULES:
            assert [(s["start"], s["end"]) for s in row[f"spans_{rule.kind}"]] == plain_spans(SECRETS[row["doc_id"]], rule), (row, rule)
    assert secrets.scan(odd).count() == len(odd_rows()) and secrets.scan(nothing).collect() == []


def test_trigram_queries():
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == frozenset([frozenset(["aki", "kia"])])
    assert secrets.trigram_query("[0-9a-f]{32,}") == secrets.ANYTHING
    assert secrets.trigram_query("abc|xy") == secrets.ANYTHING
    assert secrets.trigram_query("(abc|xyz)d?") == frozenset([frozenset(["abc"]), frozenset(["xyz"])])


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
def test_plan_uses_every_piece_once(counts):
    lines = packing.plan(counts, 64)
    used = Counter()
    for pattern, times in lines:
        assert sum(pattern) <= 64 and times > 0
        for length in pattern:
            used[length] += times
    assert used == Counter(counts)
    places = packing.Places(lines)
    taken = set()
    for length, count in counts.items():
        for sequence, offset in zip(*places.of(length, np.arange(count))):
            taken.update((int(sequence), int(offset) + i) for i in range(length))
    assert len(taken) == sum(n * c for n, c in counts.items())


def test_exact_complements_fill_sequences():
    assert packing.plan({60: 5, 40: 5}, 100) == [((60, 40), 5)]
    assert sum(t for _, t in packing.plan({50: 3, 30: 3, 20: 3}, 100)) == 3
    assert sum(t for _, t in packing.plan({40: 2, 30: 2, 20: 2, 10: 2}, 100)) == 2


SPECIAL = "<|endoftext|>"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.sampled_from([SPECIAL, SPECIAL[:7], " ", "it's", "x  y"])), max_size=8))
def test_word_lookup_gives_the_tokenizers_ids(parts):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    text = "".join(parts)
    assert np.frombuffer(packing.tokens_of(path).of(text), "<u4").tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_toxicity_fit_holds_one_matrix():
    """Memory of a fit on the driver: one line of numbers a sentence, in one copy, and nothing of the sample afterwards."""
    import tracemalloc

    bad = [a + b for a in "grob klum vist dorn plag zwek mirg sulp".split() for b in "ak el ip on ur".split()]
    texts = [". ".join(random.Random(100 * i + j).choice(bad) + " " + WORDS[j % 30] for j in range(200)) for i in range(60)] + [sentence(i, 50) for i in range(240)]
    tracemalloc.start()
    model = toxicity.fit(texts, [1] * 60 + [0] * 240, toxicity.Settings(rounds=0))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    line = 4 * len(model.landmarks.words)
    assert len(model.landmarks.words) >= 40 and not model._young and not model._old
    assert peak < 3 * 24_000 * line
    assert model.score(texts[:1])[0] > 0.5 > model.score(texts[-1:])[0]


def test_new_words_cost_the_model_alone():
    """Words never go through the whole tokenizer, and every byte of a Latin text has the tokenizer's id."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = packing.Ids(path)
    whole, ids.encode = ids.encode, None
    for text in ("".join(map(chr, range(0x250))), " ".join(map(chr, range(0x250))), " übergrößen l'été 12²  don't\n\n"):
        assert ids.of(text) == whole(text)
    assert len(ids) > 400 and Tokenizer.from_file(path).normalizer is None


def test_packing_odd_rows(odd, nothing, frame):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = packing.pack(odd, path, keep_ids=True).collect()
    assert sum(r["piece"] == 0 for r in rows) == len(odd_rows()) and all(r["length"] == len(r["ids"]) for r in rows)
    assert {(r["length"], tuple(r["ids"])) for r in rows if r["doc_id"] == 1} == {(1, (2,))}
    assert packing.pack(nothing, path).collect() == []
    special = packing.pack(frame([(1, f"x {SPECIAL} y", "x", 1, 1)], SCHEMA), path, keep_ids=True).collect()
    assert [tuple(r["ids"]) for r in special] == [(87, 220, 50256, 331, 2)]


def plain_sets(text: str, size: int) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) or frozenset([tuple(words)] if words else [])


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aAbB é\n\t.", max_size=30)), max_size=8), st.integers(1, 4))
def test_shingle_sets_are_those_of_the_words(column, size):
    found = [s for _, sets in texts.shingle_sets(pa.array(column, pa.string()), size) for s in sets]
    plain = [plain_sets(t, size) for t in column]
    assert [len(s) for s in found] == [len(s) for s in plain]
    for a, x in zip(found, plain):
        for b, y in zip(found, plain):
            assert len(np.intersect1d(a, b)) == len(x & y)


def plain_components(rows: list[tuple], size: int, percent: int) -> dict:
    sets = {k: plain_sets(t, size) for k, t in rows}
    name = {k: k for k in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                shared = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared) and name[a] > name[b]:
                    name[a], changed = name[b], True
    return name


def near_rows() -> list[tuple]:
    rng, rows = random.Random(5), []
    for group in range(6):
        base = sentence(100 + group, 80).split()
        for _ in range(12):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 6, 9])):
                words[rng.randrange(len(words))] = "w" + str(rng.random())
            rows.append((len(rows) * 3, " ".join(words)))
    return rows + [(1000, None), (1001, ""), (1002, "single"), (1003, "Single"), (1004, "two words")]


@pytest.mark.parametrize("size", [2, 5])
def test_near_groups_equal_all_pairs(frame, size):
    rows = near_rows()
    found = near_dedup.label_groups(frame([(*r, "x", 1, 1) for r in rows], SCHEMA), shingle=size).collect()
    want = plain_components(rows, size, 80)
    assert {r["doc_id"]: r["component_id"] for r in found} == want
    assert all(r["n_shingles"] == len(plain_sets(dict(rows)[r["doc_id"]], size)) and r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_leftover_members_of_a_large_bucket_are_compared_in_blocks(frame, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    rows = near_rows()
    found = near_dedup.label_groups(frame([(*r, "x", 1, 1) for r in rows], SCHEMA), shingle=2).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == plain_components(rows, 2, 80)


def test_near_odd_rows(odd, nothing):
    rows = near_dedup.label_groups(odd, shingle=2).collect()
    assert len(rows) == len(odd_rows())
    assert all(r["component_id"] is None and r["kept"] for r in rows if r["doc_id"] is None)
    assert {r["component_id"] for r in rows if r["doc_id"] in (3, 4)} == {3} and {r["component_id"] for r in rows if r["doc_id"] in (5, 6)} == {5}
    assert near_dedup.label_groups(nothing).collect() == []
    assert near_dedup.drop_near_copies(odd, shingle=2).columns == odd.columns


def test_near_groups_of_text_ids(frame):
    rows = [(f"d{k:04d}", t) for k, t in near_rows()]
    docs = frame(rows + [(None, rows[0][1]), (None, None)], "doc_id string, text string")
    found = near_dedup.label_groups(docs, shingle=5).collect()
    want = plain_components(rows, 5, 80)
    assert {r["doc_id"]: r["component_id"] for r in found if r["doc_id"]} == want
    assert [(r["component_id"], r["kept"]) for r in found if r["doc_id"] is None] == [(None, True)] * 2
    left = near_dedup.drop_near_copies(docs, shingle=5)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect() if r["doc_id"]) == sorted(set(want.values()))
    assert near_dedup.label_groups(docs.limit(0)).collect() == []


def test_estimates_and_merged_registers():
    sketch, rng = near_dedup.Sketch(), np.random.default_rng(3)
    for shared in (100, 300, 450):
        common, own = rng.integers(0, 2**64, shared, np.uint64), rng.integers(0, 2**64, (2, 500 - shared), np.uint64)
        first, second = (np.concatenate([common, o]) for o in own)
        one, two, both = near_dedup.registers([first, second, np.union1d(first, second)], sketch)
        assert (near_dedup.merged(one, two) == both).all()
        true = shared / (1000 - shared)
        assert abs(near_dedup.estimate(one[None], two[None], np.array([500]), np.array([500]), sketch)[0] - true) < 0.15


def test_components_of_a_chain(frame):
    links = frame([(i, i + 1) for i in range(40)] + [(100, 102), (101, 102)], "a long, b long")
    found = {r["id"]: r["component"] for r in components.connected(links).collect()}
    assert all(found[i] == 0 for i in range(1, 41)) and found[101] == found[102] == 100


def test_benchmark_passages(frame, odd, nothing):
    items = [(1, sentence(50, 40)), (2, sentence(51, 18)), (3, "three short words"), (4, None), (5, "")]
    benchmark = frame(items, "item_id long, text string")
    edited = items[0][1].split()
    edited[0], edited[-1] = "other", "words"
    broken = items[0][1].split()
    for i in (8, 16, 24, 32):
        broken[i] = "changed"
    docs = frame([
        (10, sentence(60, 200) + " " + items[0][1].upper().replace(" ", ", ") + "! " + sentence(61, 50), "x", 1, 1),
        (11, sentence(62, 30) + " " + items[1][1] + " " + items[0][1], "x", 1, 1), (12, "Three short words.", "x", 1, 1), (13, sentence(63, 500), "x", 1, 1),
        (14, sentence(64, 20) + " " + " ".join(edited), "x", 1, 1), (15, " ".join(broken), "x", 1, 1), (16, None, "x", 1, 1), (17, "", "x", 1, 1),
        (18, " ".join(items[0][1].split()[:37]), "x", 1, 1),
    ], SCHEMA)
    found = {(r["doc_id"], r["item_id"]): r for r in decontaminate.find(docs, benchmark).collect()}
    assert set(found) == {(10, 1), (11, 1), (11, 2), (12, 3), (14, 1), (18, 1)}
    assert found[(10, 1)]["similarity"] == 1 and found[(10, 1)]["first_word"] == 200 and found[(10, 1)]["words"] == 40
    assert found[(14, 1)]["similarity"] == pytest.approx(34 / 37)  # 34 of 36 shingles are common
    assert decontaminate.drop_leaks(docs, benchmark).columns == docs.columns
    assert {r["doc_id"] for r in decontaminate.drop_leaks(docs, benchmark).collect()} == {13, 15, 16, 17}
    assert decontaminate.find(odd, benchmark).collect() == [] and decontaminate.find(nothing, benchmark).collect() == []
    assert decontaminate.drop_leaks(odd, benchmark.limit(0)).count() == len(odd_rows())


def test_edited_passages_whose_prints_are_far_apart(frame):
    seeds = [38, 190, 227, 309]  # 32 of 40 shingles are common, and 16 to 19 bits differ
    docs = []
    for n in seeds:
        words = sentence(5000 + n, 40).split()
        words[:2], words[-2:] = ["other", "words"], ["last", "ones"]
        docs.append((n, " ".join([sentence(7000 + n, 30), *words, sentence(9000 + n, 40)])))
    items = [(n, sentence(5000 + n, 40)) for n in seeds]
    found = decontaminate.find(frame(docs, "doc_id long, text string"), frame(items * 2 + [(None, items[0][1]), (seeds[1], "other text")], "item_id long, text string"))
    assert sorted((r["doc_id"], r["item_id"] or 0, r["similarity"]) for r in found.collect()) == sorted([(n, n, 0.8) for n in seeds] + [(seeds[0], 0, 0.8)])


PAGES = {
    "<p>A<p>B <b>c<i>d</b> e": "A\n\nB cd e",
    "<ul><li>x<li>y<ol start=3><li>q<li>r</ol></ul>": "- x\n- y\n  3. q\n  4. r",
    "<table><tr><th>Name<th>Qty<tr><td>Apple pie<td>3<td>z</table>": "Name       Qty\nApple pie  3    z",
    "<div hidden>no</div><div style='display: none'>no</div><script>var t='</p>'</script>yes": "yes",
    "<pre>a  b\n c</pre>": "a  b\n c",
    "<![if x]>tail<br>end&amp;&eacute;": "tail\nend&é",
    "<title>t</title><h1>Head</h1>text<div>block</div>": "Head\n\ntext\nblock",
    "": "", "plain": "plain", "<p": "<p", "<b>open": "open",
    "<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math>": "x=2",
    "<svg><title>t</title><desc>d</desc><defs><text>no</text></defs><text>label</text></svg> <i aria-hidden='true'>star</i>": "label star",
    "<p style='visibility: hidden'>no <span style='visibility:visible'>yes</span> no</p><p style='color:red;VISIBILITY:collapse'>no": "yes",
    "<ol><li>a<li style='visibility:hidden'>no<li>c</ol>": "1. a\n3. c",
    "<table><tr><td colspan=2>two columns<td>z<tr><td>a<td>b<td>c</table>": "two columns  z\na  b         c",
    "<table><tr><td rowspan=2>r<td>1<tr><td>2<tr><td>s<td>3</table>": "r  1\n   2\ns  3",
    "<table><tr><td rowspan=0>r<td>1<tr><td>2</table>": "r  1\n   2",
    "<table><tr><td colspan=1000>big<td>x<tr><td>a<td>b</table>": "big   x\na  b",
    "<table><tr><td colspan=x rowspan=-1>odd<td>y</table>": "odd  y",
    "<div>" * 160 + "<script>var no=1</script><div hidden>no</div><p>shown" + "</div>" * 160: "shown",
    "<ul><li>" * 200 + "deep": "- " * 200 + "deep",
    "<table><tr><td>" * 300 + "inner": "inner",
}


def test_pages(frame):
    for html, text in PAGES.items():
        assert html_text.visible_text(html) == text, html
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    rows = [(1, None, "a"), (2, deep, "b"), (2, deep, "b"), (None, "<p>x", "c")]
    found = html_text.extract(frame(rows, "page_id long, html string, text string")).collect()
    assert sorted((r["page_id"] or 0, r["text"]) for r in found) == [(0, "x"), (1, ""), (2, "deep"), (2, "deep")]
    assert html_text.extract(frame([], "page_id long, html string")).collect() == []


def grid_of(rows: list[list[tuple[str, int, int]]]) -> dict:
    """Plain form of cell placement: (row, column) -> text of the cell that covers it."""
    held = {}
    for r, row in enumerate(rows):
        c = 0
        for text, columns, span in row:
            while (r, c) in held:
                c += 1
            held.update({(r + i, c + j): text for i in range(min(span, len(rows) - r)) for j in range(columns) if (r + i, c + j) not in held})
            c += columns
    return held


cells = st.lists(st.lists(st.tuples(st.integers(1, 3), st.integers(1, 3)), min_size=1, max_size=4), min_size=1, max_size=4)


@settings(max_examples=150, deadline=None)
@given(cells)
def test_cells_stand_in_their_columns(shape):
    names = iter(f"{a}{b}" for a in "abcdefghijklmnopq" for b in "xyz")
    rows = [[(next(names), *size) for size in row] for row in shape]
    html = "<table>" + "".join("<tr>" + "".join(f"<td colspan={c} rowspan={r}>{t}" for t, c, r in row) for row in rows) + "</table>"
    lines = html_text.visible_text(html).split("\n")
    assert [w for line in lines for w in line.split()] == [t for row in rows for t, _, _ in row]
    # Cells that begin in one column, in any rows, begin at one place of the line.
    begins = {}
    held = grid_of(rows)
    for r, row in enumerate(rows):
        for text, _, _ in row:
            column = min(c for (i, c), t in held.items() if t == text)
            begins.setdefault(column, set()).add(next(line.index(text) for line in lines if text in line.split()))
    alone = {c for c in begins if any(cols == 1 for row in rows for t, cols, _ in row if min(k for (i, k), x in held.items() if x == t) == c)}
    assert all(len(begins[c]) == 1 for c in alone)


def test_a_language_of_long_texts_alone_is_known(frame):
    long = [" ".join(f"zu{sentence(k * 1000 + i, 1)}ka" for i in range(4000)) for k in range(3)]
    rows = [(k, t, "long") for k, t in enumerate(long)] + [(10 + k, sentence(k, 50), "short") for k in range(30)]
    model = language_id.learn(frame(rows, "doc_id long, text string, lang string"))
    assert set(model.contents) == {"long", "short"} and model.predict(long[0][:300])[0] == "long" and model.predict(sentence(99, 40))[0] == "short"
    assert all(len(c) <= model.settings.dictionary_bytes for c in model.contents.values())


def test_language_of_odd_rows(frame, odd, nothing):
    rows = [(i, sentence(i, 40), "aa") for i in range(20)] + [(i, sentence(i, 40)[::-1], "bb") for i in range(20, 35)] + [(99, None, "aa"), (98, "x", None)]
    model = language_id.learn(frame(rows, "doc_id long, text string, lang string"))
    assert list(model.contents) == ["aa", "bb"]
    found = language_id.predict(odd, model).collect()
    assert len(found) == len(odd_rows()) and {r["lang_pred"] for r in found if r["doc_id"] in (1, 2, 7)} == {"und"}
    assert {r["lang_pred"] for r in found if r["doc_id"] in (3, 8)} == {"aa"} and all(0 <= r["score"] <= 1 for r in found)
    assert model.predict("12 34 !!")[0] == "und" and model.predict(sentence(77, 30)[::-1])[0] == "bb"
    assert language_id.predict(nothing, model).collect() == []


def test_toxicity_of_inserted_letters_and_odd_rows(frame, odd, nothing):
    clean = [sentence(i, 30) for i in range(120)]
    bad = [f"{sentence(1000 + i, 8)} {word} {sentence(2000 + i, 8)}." for i in range(30) for word in ("grumblewort", "nastiform")]
    model = toxicity.fit(clean + bad, [0] * len(clean) + [1] * len(bad))
    score = lambda text: float(model.score([text])[0])
    assert score("ran grumblewort sel") > 0.5 and score("ran g r u m b l e w o r t sel") > 0.5 and score("ran grum-blewort sel") > 0.5
    assert score("ran grumxblewort sel") > 0.3 > score(sentence(7, 50))
    found = toxicity.predict(odd, model).collect()
    assert len(found) == len(odd_rows()) and all(r["predicted"] == 0 for r in found)
    assert toxicity.predict(nothing, model).collect() == [] and toxicity.drop_toxic(odd, model).columns == odd.columns
    assert 0 < toxicity.fit(["a b c"], [0]).score(["x", None, ""])[0] < 1


def plain_kernel(a: str, b: str, s: toxicity.Settings) -> float:
    """Normalised kernel by listing all subsequences of three letters."""
    def listed(word: str) -> Counter:
        found = Counter()
        for i, j, k in combinations(range(len(word)), 3):
            if k - i <= s.span:
                found[word[i] + word[j] + word[k]] += s.decay ** (k - i - 2)
        return found
    x, y = listed(a), listed(b)
    size = lambda c: sum(v * v for v in c.values()) ** 0.5
    return sum(v * y[c] for c, v in x.items()) / (size(x) * size(y)) if x and y else 0.0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abcé", min_size=3, max_size=9), min_size=1, max_size=6, unique=True), st.lists(st.text("abcéz", max_size=12), max_size=8, unique=True))
def test_kernel_is_that_of_listed_subsequences(landmarks, words):
    s = toxicity.Settings(least=0.0)
    found = toxicity.Landmarks(landmarks, s).kernel(words) if words else np.zeros((0, len(landmarks)))
    want = np.array([[plain_kernel(w, m, s) ** s.power for m in landmarks] for w in words]).reshape(found.shape)
    assert np.allclose(found, want)
    weak = toxicity.Landmarks(landmarks, toxicity.Settings(least=0.5)).kernel(words) if words else found
    assert (np.isclose(weak, want) | ((weak == 0) & (want <= 0.5**s.power + 1e-9))).all()


def test_values_do_not_depend_on_the_batch(monkeypatch):
    monkeypatch.setattr(toxicity, "MOST_TOKENS", 20)
    clean, bad = [sentence(i, 30) for i in range(60)], [f"{sentence(1000 + i, 8)} grumblewort {sentence(2000 + i, 8)}" for i in range(20)]
    model = toxicity.fit(clean + bad, [0] * 60 + [1] * 20)
    together = model.score(clean + bad)
    assert np.allclose(together, [model.score([t])[0] for t in clean + bad])


def test_an_insult_with_many_endings_is_one_landmark():
    split = [[[f"grumble{e}"]] for e in "abcdef"] + [[[f"gram{e}"]] for e in "abcdefghijklmnopqr"]
    assert toxicity.chosen_landmarks(split, [1] * 6 + [0] * 18, toxicity.Settings()) == ["grumble"]


def test_ordinal_grades(odd, nothing):
    texts_ = [sentence(i, 20) + " bad" * (2 - i % 3) + " good" * (i % 3) for i in range(90)]
    model = quality.fit([i % 3 for i in range(90)], texts_)
    assert (np.diff(model.thresholds) > 0).all()
    scores = np.concatenate([s for _, _, s in model.scores(pa.array(texts_))])
    expected = model.above(scores).sum(1)
    assert np.corrcoef(expected, np.arange(90) % 3)[0, 1] > 0.9
    found = quality.predict(odd, model).collect()
    assert len(found) == len(odd_rows()) and all(r["tails"][0] >= r["tails"][1] and 0 <= r["expected_grade"] <= 2 for r in found)
    assert quality.predict(nothing, model).collect() == []
    only = quality.fit([3, 3], ["a", "b"])
    assert {r["expected_grade"] for r in quality.predict(odd, only).collect()} == {3.0}


def test_the_fitted_weights_are_near_the_greatest_likelihood():
    """The chance of the grades by the plain formula: every small move of the thresholds or the scores makes it smaller."""
    texts_ = [sentence(i, 20) + " bad" * (i * 7 % 4) + " good" * (i % 3) for i in range(120)]
    grades = [min(2, max(0, (i % 3) + (i * 7 % 4 == 0) - (i * 7 % 4 == 3))) for i in range(120)]
    tight = quality.Settings(bits=10, steps=3000, ridge=1e-2)
    model = quality.fit(grades, texts_, tight)
    scores = np.concatenate([s for _, _, s in model.scores(pa.array(texts_))])

    def likelihood(s, t, w):
        total = 0.0
        for i, g in enumerate(grades):
            at = lambda k: 1.0 if k < 0 else 0.0 if k >= len(t) else 1 / (1 + np.exp(t[k] - s[i]))  # noqa: E731,B023
            total += np.log(at(g - 1) - at(g))
        return total / len(grades) - tight.ridge * float(w @ w) / 2

    best = likelihood(scores, model.thresholds, model.weights)
    for k in range(2):
        for move in (-0.1, 0.1):
            shifted = model.thresholds.copy()
            shifted[k] += move
            assert likelihood(scores, shifted, model.weights) < best + 1e-5
    for scale in (0.9, 1.1):
        assert likelihood(scores * scale, model.thresholds, model.weights * scale) < best + 1e-5
    tails = model.above(scores)
    assert np.allclose(tails, 1 / (1 + np.exp(model.thresholds[None] - scores[:, None])))


def test_copies_take_one_place_of_a_sample(spark, frame):
    distinct = [sentence(i, 20) for i in range(30)]
    hashes = {r["text"]: r["hash"] for r in frame([(t,) for t in distinct], "text string").selectExpr("text", "xxhash64(text) AS hash").collect()}
    order = sorted(distinct, key=hashes.get)
    column = [t for n, t in enumerate(order) for _ in range(50 if n in (0, 3) else 1)]
    docs = frame([(i, t, "aa") for i, t in enumerate(column)] + [(0, column[0], "aa")] * 40, "doc_id long, text string, lang string")
    labels = frame([(i, i % 2 if column[i] == order[0] else 0) for i in range(len(column))] + [(0, 0)] * 3, "doc_id long, label int")
    found = samples.labelled(docs, labels, 10, 1_000, "doc_id", "text", "label")
    assert found == [(0, t) for t in order[:10]] + [(1, order[0])]
    model = language_id.learn(docs, language_id.Settings(sample_docs=10))
    assert model.contents["aa"].decode() == " " + " ".join(map(language_id.reduced, order[:10]))


def test_word_endings_are_those_of_each_text_alone():
    texts_ = [sentence(i, 9_000) for i in range(60)] + ["a", "b a", "", None, " x", "äb", "c"]
    column = pa.array(texts_)
    assert len(list(texts.chunks(column))) > 1
    apart = [[x[1:] for x in quality.features(pa.array([t], pa.string()), 16)] for t in texts_]
    row_feature_value = [(row + t, f, v) for row, text, feature, value in quality.features(column, 16) for t, f, v in zip(text, feature, value)]
    assert row_feature_value == [(row, f, v) for row, parts in enumerate(apart) for _, feature, value in parts for f, v in zip(feature, value)]

    def invented(seed: int, count: int, tail: str) -> str:
        letters = random.Random(seed)
        return " ".join("".join(letters.choices("bcdfghjklm", k=9)) + tail for _ in range(count))

    graded = [invented(i, 3_000, "ing" if i % 2 else "eds") for i in range(80)]
    assert len(list(texts.chunks(pa.array(graded)))) > 1
    model = quality.fit([i % 2 for i in range(80)], graded)
    unseen = [invented(1_000 + i, 30, "ing" if i % 2 else "eds") for i in range(40)]
    scores = np.concatenate([s for _, _, s in model.scores(pa.array(unseen))])
    assert scores[1::2].min() > scores[::2].max()
    assert scores.tolist() == [float(s[0]) for text in unseen for _, _, s in model.scores(pa.array([text]))]


def test_models_without_labels(frame, odd, nothing):
    unlabelled = frame([], "doc_id long, toxic int, quality int")
    for docs in (odd, nothing):
        model = toxicity.learn(docs, unlabelled)
        assert toxicity.drop_toxic(odd, model).count() == len(odd_rows())
        assert {r["predicted"] for r in toxicity.predict(odd, model).collect()} == {0}
        grades = quality.predict(odd, quality.learn(docs, unlabelled)).collect()
        assert len(grades) == len(odd_rows()) and {r["expected_grade"] for r in grades} == {0.0}
    assert language_id.learn(frame([], "doc_id long, text string, lang string")).predict("some words")[0] == "und"


def test_pipeline_on_empty_tables(spark, tmp_path):
    import corpus_pipeline

    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_hashing_many_texts_takes_little_memory(monkeypatch):
    """A batch of texts is hashed in pieces of half a megabyte, whose number changes no set."""
    import tracemalloc

    column = pa.array([sentence(seed, 2_000) for seed in range(400)])
    tracemalloc.start()
    found = [s for _, sets in texts.shingle_sets(column, 5) for s in sets[:1]]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) >= 6 and peak < 60_000_000
    every = [s.tobytes() for _, sets in texts.shingle_sets(column, 5) for s in sets]
    monkeypatch.setattr(texts, "CHUNK", 2_000_000)
    assert [s.tobytes() for _, sets in texts.shingle_sets(column, 5) for s in sets] == every

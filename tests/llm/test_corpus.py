"""Operators that hold documents against each other: shards, copies, leaks, packs, repeats."""

import collections
import itertools
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from made_up import WORD, prose
from pyspark.sql.functions import lit
from tokenizers import Tokenizer

import corpus_pipeline
from textquarry.llm import contamination, packing, repeats, sharding, simhash
from textquarry.llm.components import connected_components
from textquarry.llm.global_order import global_order
from textquarry.llm.near_copies import keep_one_per_copy, shingles

FOLDER = "/root/testdata/sf0.001"

# ---------------------------------------------------------------- shards


def test_global_order_equals_a_loop(spark):
    rows = [(i * 7919 % 1000 // 10, i, i % 13) for i in range(1000)]
    path_df = spark.createDataFrame(rows, "a bigint, b bigint, w bigint").repartition(5)
    from textquarry.llm.common import materialize

    got = {r["b"]: (r["_row"], r["_before"], r["_total"]) for r in global_order(materialize(path_df, "t"), ["a", "b"], "w").collect()}
    before, total = 0, sum(r[2] for r in rows)
    for row, (a, b, w) in enumerate(sorted(rows)):
        assert got[b] == (row, before, total)
        before += w


def test_shards_of_odd_rows(make_docs, odd_rows):
    rows = odd_rows + [(100 + i, prose(i, i % 90)) for i in range(300)]
    got = sharding.assign_shards(make_docs(rows), 8).collect()
    assert len(got) == len(rows)
    want = collections.Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    shards = collections.defaultdict(list)
    for r in got:
        shards[r["shard"]].append(r)
    longest, share = max(r["size"] for r in got), sum(r["size"] for r in got) / 8
    last = None
    for s in sorted(shards):
        rows = sorted(shards[s], key=lambda r: r["slot"])
        assert [r["slot"] for r in rows] == list(range(len(rows)))
        assert abs(sum(r["size"] for r in rows) - share) <= longest
        for r in rows:  # contiguous in id order, NULL first
            key = (r["doc_id"] is not None, r["doc_id"] or 0)
            assert last is None or key >= last
            last = key
    assert sharding.assign_shards(make_docs([])).count() == 0


def test_written_shards_hold_every_row(spark, make_docs, odd_rows, tmp_path):
    docs = make_docs(odd_rows)
    sharding.write_shards(docs, str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert set(back.columns) == set(docs.columns)
    same = ["doc_id", "text", "lang", "source"]
    assert sorted(map(str, back.select(same).collect())) == sorted(map(str, docs.select(same).collect()))


# ---------------------------------------------------------------- near copies


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(keys, linked):
    parent = list(range(len(keys)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if linked(keys[i], keys[j]):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(keys))]


def check_groups(got, rows):
    prints = [brute_fingerprint(t) for _, t, *_ in rows]
    roots = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for root, (doc_id, *_) in zip(roots, rows):
        if doc_id is not None:
            least[root] = min(least.get(root, doc_id), doc_id)
    want = collections.Counter((r[0], f"{p:016x}", least.get(root)) for r, p, root in zip(rows, prints, roots))
    assert collections.Counter(map(tuple, got.collect())) == want


def near_copies():
    rows = []
    for g in range(12):
        words = prose(g, 400).split()
        for c in range(6):
            copy = words[:]
            for k in range(c):
                copy[(k * 97 + g) % len(copy)] = "changed"
            rows.append((1000 - len(rows), " ".join(copy)))
    return rows


def near_copies_of_each():
    """Originals of 200 words with copies that have 1 to 9 words changed."""
    rows = []
    for g in range(20):
        words = prose(300 + g, 200).split()
        for c in range(10):
            rows.append((len(rows), " ".join(f"new{c}" if k % 20 == g and k // 20 < c else w for k, w in enumerate(words))))
    return rows


def test_groups_equal_brute_force(make_docs, odd_rows):
    rows = odd_rows + near_copies() + [(2000, "ONE Two"), (2001, "one two"), (2002, "É one"), (2003, "é one")]
    check_groups(simhash.simhash_groups(make_docs(rows)), rows)
    assert simhash.simhash_groups(make_docs([])).count() == 0


def test_every_link_is_found_among_planted_bits(spark):
    rng = random.Random(4)
    prints = [rng.getrandbits(64) for _ in range(150)]
    for p in prints[:100]:
        for bits in (1, 2, 2, 3):
            prints.append(p ^ sum(1 << b for b in rng.sample(range(64), bits)))
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp bigint"))
    component = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    roots = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    ours = [component.get(s, s) for s in signed]
    assert len({(a, b) for a, b in zip(roots, ours)}) == len(set(roots)) == len(set(ours))


@pytest.mark.parametrize("shape", ["chain", "star", "random", "loops", "empty"])
def test_components(spark, shape):
    rng = random.Random(2)
    edges = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(0, i) for i in range(1, 200)] + [(500, 501)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(180)],
        "loops": [(5, 5), (1, 2), (2, 1), (None, 3), (1, 2)],
        "empty": [],
    }[shape]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    nodes = sorted({x for e in real for x in e})
    links = {frozenset(e) for e in real}
    roots = brute_components(nodes, lambda a, b: frozenset((a, b)) in links)
    least = {}
    for n, r in zip(nodes, roots):
        least.setdefault(r, n)
    assert got == {n: least[r] for n, r in zip(nodes, roots)}


def test_one_of_each_group_stays(make_docs):
    rows = near_copies()
    docs = make_docs(rows)
    groups = simhash.simhash_groups(docs)
    want = {r["component_id"] for r in groups.collect()}
    kept = simhash.keep_one_per_group(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want) and kept.columns == docs.columns


def test_one_row_of_each_group_stays(make_docs):
    rows = [(None, prose(1, 60)), (None, prose(2, 60)), (None, prose(2, 60)), (1, prose(3, 60)), (1, prose(3, 60))]
    # Id 2 has a text of its own and a copy of the text of id 1.
    rows += [(2, prose(3, 60)), (2, prose(4, 60)), (None, prose(4, 60)), (5, None), (None, "")]
    want = collections.Counter([(None, prose(1, 60)), (None, prose(2, 60)), (1, prose(3, 60)), (2, prose(4, 60)), (5, None)])
    docs = make_docs(rows)
    for kept in (simhash.keep_one_per_group(docs), keep_one_per_copy(docs)):
        assert collections.Counter((r["doc_id"], r["text"]) for r in kept.collect()) == want


def test_stage_drops_near_copies(make_docs):
    rows = near_copies_of_each()
    kept = corpus_pipeline.near_duplicates(None, make_docs(rows), "").collect()
    sets = [set(shingles(t).tolist()) for _, t in rows]
    roots = brute_components(sets, lambda a, b: len(a & b) >= 0.8 * len(a | b))
    assert len(kept) == len(set(roots)) < len(rows)


# ---------------------------------------------------------------- leaks


def test_exact_and_edited_leaks(spark, make_docs):
    items = [(i, prose(10_000 + i, 40)) for i in range(30)] + [(98, "too short"), (99, None)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    rows, want = [], set()
    for i in range(30):
        words = items[i][1].split()
        if i % 3 == 1:
            words = ["edited" if k % 6 == 3 else w for k, w in enumerate(words)]
        if i % 3 == 2:
            words = [w for k, w in enumerate(words) if k % 9 != 4]
        rows.append((i, f"{prose(i, 100)} {' '.join(words)}, {prose(500 + i, 90)}"))
        want.add((i, i))
    rows += [(100 + i, prose(700 + i, 300)) for i in range(60)] + [(200, None), (201, ""), (202, "too short")]
    got = contamination.find_leaks(make_docs(rows), benchmark)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want
    first = got.where("doc_id = 0").first()
    assert (first["score"], first["start_word"], first["end_word"]) == (1.0, 100, 140)
    kept = contamination.drop_leaks(make_docs(rows), benchmark)
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows if r[0] >= 100}


def test_leaks_over_several_blocks(spark, make_docs, monkeypatch):
    monkeypatch.setattr(contamination, "BLOCK_CHARS", 300)
    items = [(i, prose(i, 30)) for i in range(9)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs = make_docs([(i, f"before {t} after") for i, t in items] * 2)
    got = collections.Counter((r["doc_id"], r["item_id"]) for r in contamination.find_leaks(docs, benchmark).collect())
    assert got == collections.Counter({(i, i): 2 for i in range(9)})
    assert contamination.find_leaks(docs, benchmark.limit(0)).count() == 0
    assert contamination.find_leaks(make_docs([]), benchmark).count() == 0


def test_alignment_equals_a_table():
    rng = np.random.default_rng(5)
    for _ in range(60):
        a, b = rng.integers(1, 5, rng.integers(1, 12)), rng.integers(1, 5, rng.integers(1, 20))
        h = np.zeros((len(a) + 1, len(b) + 1))
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                s = contamination.MATCH if a[i - 1] == b[j - 1] else contamination.MISMATCH
                h[i, j] = max(0, h[i - 1, j - 1] + s, h[i - 1, j] + contamination.GAP, h[i, j - 1] + contamination.GAP)
        assert contamination.align(a, b)[0] == h.max()


def test_every_run_of_an_item_has_a_seed():
    index = contamination.ItemIndex([(1, prose(1, 60)), (2, prose(2, 9))])
    index.choose_seeds(np.random.default_rng(1).integers(1, 50, len(index.grams)))
    for item in range(2):
        at = {o for places in index.places for i, o in places if i == item}
        last = len(index.words[item]) - contamination.GRAM
        for start in range(max(1, last - contamination.SEED_SPAN + 2)):
            assert at & set(range(start, start + contamination.SEED_SPAN))


@pytest.mark.parametrize("hot", [1, 40])
def test_edited_copies_beside_exact_ones(spark, make_docs, hot):
    items = [(i, prose(20_000 + i, 40)) for i in range(8)]
    rows = []
    for i, text in items:
        edited = " ".join("edited" if k % 6 == 3 else w for k, w in enumerate(text.split()))
        rows += [(1000 * i + c, f"{prose(i, 50)} {text}") for c in range(hot)]
        rows.append((1000 * i + 999, f"{prose(90 + i, 50)} {edited} {prose(190 + i, 50)}"))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in contamination.find_leaks(make_docs(rows), benchmark).collect()}
    assert got == {(doc_id, doc_id // 1000) for doc_id, _ in rows}
    assert contamination.drop_leaks(make_docs(rows), benchmark).count() == 0


CHINESE = "\u5730\u7403\u7ed5\u592a\u9633\u516c\u8f6c\u4e00\u5468\u5927\u7ea6\u9700\u8981\u4e09\u767e\u516d\u5341\u4e94\u5929\u591a"


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_short_unspaced_and_partial_items(spark, make_docs, kind):
    as_id = str if kind == "string" else int
    question, long_item = "What is the capital of Peru?", prose(31_000, 600)
    items = [(as_id(1), question), (as_id(2), CHINESE), (as_id(3), long_item), (as_id(4), "Who is he"), (None, question)]
    part = " ".join(long_item.split()[150:350])
    rows = [
        (1, f"{prose(1, 50)} what is the CAPITAL of Peru {prose(2, 50)}"),
        (2, f"\u524d{CHINESE}\u540e"),
        (3, f"{prose(3, 50)} {part} {prose(4, 50)}"),
        (4, f"{prose(5, 50)} what is the capital of France {prose(6, 20)} who is he"),
        (5, "\u5730\u7403\u7ed5" + "\u597d" * 30),
        (6, f"{prose(7, 50)} {' '.join(long_item.split()[10:25])}"),
        (7, prose(8, 40_000)),
    ]
    benchmark = spark.createDataFrame(items, f"item_id {kind}, text string")
    found = contamination.find_leaks(make_docs(rows), benchmark)
    assert found.schema["item_id"].dataType == benchmark.schema["item_id"].dataType
    got = {(r["doc_id"], r["item_id"]): r for r in found.collect()}
    assert set(got) == {(1, as_id(1)), (1, None), (2, as_id(2)), (3, as_id(3))}
    partial = got[3, as_id(3)]
    assert round(partial["score"] * 600) >= 200 and partial["end_word"] - partial["start_word"] >= 200
    kept = contamination.drop_leaks(make_docs(rows), benchmark)
    assert {r["doc_id"] for r in kept.collect()} == {4, 5, 6, 7}


def test_leaks_equal_an_alignment_of_every_pair(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id is not null")
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in contamination.find_leaks(docs, benchmark).collect()}
    want, number = set(), {}
    items = [(r["item_id"], contamination.words_of(r["text"] or "")) for r in benchmark.collect()]
    items = [(i, np.array([number.setdefault(w, len(number) + 1) for w in words])) for i, words in items if len(words) >= 4]
    for r in docs.collect():
        words = np.array([number.get(w, 0) for w in contamination.words_of(r["text"] or "")])
        for item_id, item in items:
            need = contamination.needed_score(len(item))
            # Word matches alone, without any order, are an upper bound of the score.
            if len(words) and 2 * np.isin(words, item).sum() >= need and contamination.align(item, words)[0] >= need:
                want.add((r["doc_id"], item_id))
    assert got == want and want


def test_numbers_of_ngrams_may_wrap_around():
    index = contamination.ItemIndex([(1, prose(1, 60))])
    index.base = (1 << 40) + 1
    index.grams = np.unique(index._codes(index.words[0]))
    index.choose_seeds(np.ones(len(index.grams), np.int64))
    assert [m[0] for m in index.matches(f"x {prose(1, 60)} y")] == [1] and index.matches(prose(2, 90)) == []


# ---------------------------------------------------------------- packs


def check_plan(plan, counts, capacity):
    got = collections.Counter()
    for f in plan:
        assert f.bins > 0 and sum(n * u for n, u in f.parts) <= capacity
        for n, u in f.parts:
            got[n] += u * f.bins
    assert got == collections.Counter({n: c for n, c in counts.items() if c})
    return sum(f.bins for f in plan)


def optimum(lengths, capacity):
    """Fewest bins by exhaustive search."""
    lengths = sorted(lengths, reverse=True)
    best = [len(lengths)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for room in set(bins):
            if room >= lengths[i]:
                rest = list(bins)
                rest.remove(room)
                place(i + 1, [*rest, room - lengths[i]])
        place(i + 1, [*bins, capacity - lengths[i]])

    place(0, [])
    return best[0]


def test_bin_completion_is_optimal_on_small_cases():
    rng = random.Random(8)
    for _ in range(40):
        lengths = [rng.randint(5, 40) for _ in range(10)]
        counts = collections.Counter(lengths)
        assert check_plan(packing.bin_completion(counts, 60), counts, 60) == optimum(lengths, 60)


@pytest.mark.parametrize("counts, want", [({59: 4, 10: 8, 7: 12}, 4), ({59: 20, 10: 40, 7: 60}, 20)])
def test_bins_that_need_a_middle_number_of_a_length(counts, want):
    assert check_plan(packing.bin_completion(counts, 100), counts, 100) == want


def test_bin_completion_is_optimal_where_many_fit():
    rng = random.Random(18)
    for _ in range(60):
        few = rng.sample(range(6, 32), 4)
        lengths = [rng.choice(few) for _ in range(12)]
        counts = collections.Counter(lengths)
        assert check_plan(packing.bin_completion(counts, 60), counts, 60) == optimum(lengths, 60)


def test_fillings_are_all_undominated_ones():
    rng = random.Random(28)
    for _ in range(30):
        counts = {n: rng.randint(1, 6) for n in rng.sample(range(4, 40), 5)}
        largest, capacity = max(counts), 60
        room, rest = capacity - largest, dict(counts)
        rest[largest] -= 1
        got = {tuple(sorted(parts[1:])) for parts in packing.fillings(counts, largest, capacity, packing.Budget(1, 10**6))}
        names = [n for n in sorted(rest) if rest[n]]
        if room in names:
            assert got == {((room, 1),)}
            continue
        want = set()
        for uses in itertools.product(*[range(rest[n] + 1) for n in names]):
            left = room - sum(n * u for n, u in zip(names, uses))
            held = [0, *[n for n, u in zip(names, uses) if u]]
            spare = [n for n, u in zip(names, uses) if u < rest[n]]
            if left >= 0 and not any(m < n <= m + left for m in held for n in spare):
                want.add(tuple((n, u) for n, u in zip(names, uses) if u))
        assert got == want


def test_a_spent_budget_keeps_the_incumbent():
    counts = {59: 4, 10: 8, 7: 12}
    for nodes, steps in ((0, 100), (5, 3), (1, 10**6)):
        assert check_plan(packing.bin_completion(counts, 100, nodes, steps), counts, 100) in (4, 5)


def test_bin_completion_on_large_counts():
    rng = random.Random(9)
    for _ in range(8):
        counts = {n: rng.randint(0, 10**rng.randint(0, 6)) for n in rng.sample(range(1, 2049), 300)}
        fit = check_plan(packing.best_fit_decreasing({n: c for n, c in counts.items() if c}, 2048), counts, 2048)
        got = check_plan(packing.bin_completion(counts, 2048, 300), counts, 2048)
        assert packing.lower_bound({n: c for n, c in counts.items() if c}, 2048) <= got <= fit
    assert packing.bin_completion({}, 2048) == []


def test_completion_beats_best_fit():
    counts = collections.Counter({100 - n: 3 for n in range(30, 60)} | {n: 3 for n in range(30, 60, 2)})
    plan = packing.bin_completion(counts, 100)
    assert check_plan(plan, counts, 100) <= sum(f.bins for f in packing.best_fit_decreasing(counts, 100))


def test_word_tokens_equal_the_tokenizer():
    words = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    texts = [
        "", "a'RE it's I'LL 12½ ²x \x85 \xa0y \x1c z \x1f", "ÀÉ×÷ßµª <|endoftext|> x", "Ω é İ ﬁ", "''s '' 're",
        "é " + "x" * 3000, "\x00 \x7f \xad", prose(1, 300), prose(2, 200, "fr"), "!!'sa'b .'re",
    ]
    for _ in range(2):
        got = words.encode_batch(texts)
        assert [g.tolist() for g in got] == [words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 50)
    words = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    for i in range(30):
        text = prose(i % 7, 40 + i)
        assert words.encode_batch([text, "the"])[0].tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


def test_packs_of_odd_rows(make_docs, odd_rows):
    rows = odd_rows + [(100 + i, prose(i, 1 + i * 7 % 200)) for i in range(200)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = collections.Counter()
    for doc_id, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            cut = np.array(ids[at : at + 2048], "<u4")
            want[doc_id, piece, at, len(cut), zlib.crc32(cut.tobytes())] += 1
    got = packing.pack_documents(make_docs(rows)).collect()
    assert collections.Counter(tuple(r)[:5] for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert packing.pack_documents(make_docs([])).count() == 0


# ---------------------------------------------------------------- repeats


def brute_repeats(rows, window=20):
    """Rows sorted by id; equal (id, text) pairs are one document."""
    out, seen = {}, set()
    for key, text in rows:
        words, gone = WORD.findall(text or ""), set()
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            if w in seen:
                gone.update(range(i, i + window))
            seen.add(w)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[key, text] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def repeated_rows():
    shared, short = prose(77, 60), prose(78, 19)
    rows = [(i, f"{prose(i, 30 + i)} {shared} {prose(100 + i, 25)} {short}") for i in range(1, 12)]
    rows += [(20, prose(3, 33)), (21, rows[4][1]), (22, rows[4][1]), (23, "a " * 45), (24, "b c " * 40)]
    words = prose(200, 300).split()
    for i in range(30, 45):
        copy = words[:]
        copy[i * 5] = "edit"
        rows.append((i, "\n".join(copy)))
    rows += [(50, f"{prose(200, 25)} x {prose(200, 300)[40:]}"), (51, " ".join(words[10:60] * 3)), (52, " ".join(words[:20]))]
    return rows


def test_repeats_equal_brute_force(make_docs):
    rows = repeated_rows() + [(60, None), (61, ""), (62, " \n"), (63, prose(9, 30_000)), (64, prose(9, 30_000) + " end")]
    got = {(r[0],): tuple(r)[1:] for r in repeats.remove_repeats(make_docs(rows)).collect()}
    want = brute_repeats(sorted(rows))
    assert got == {(k,): v for (k, _), v in want.items()}


def test_repeats_with_repeated_and_missing_ids(make_docs):
    rows = [(1, prose(1, 50)), (1, prose(1, 50)), (2, prose(1, 30) + " more"), (None, prose(1, 50)), (3, prose(2, 40)), (3, prose(2, 40) + " x")]
    got = [tuple(r) for r in repeats.remove_repeats(make_docs(rows)).collect()]
    assert sorted(r[:3] for r in got if r[0] in (1, 2)) == [(1, 50, 0), (1, 50, 0), (2, 31, 30)]
    assert [r[:3] for r in got if r[0] is None] == [(None, 50, 50)]
    assert sum(r[2] for r in got if r[0] == 3) == 40
    assert repeats.remove_repeats(make_docs([])).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_windows_of_few_words(make_docs, seed):
    """Periodic and nearly periodic texts over a tiny vocabulary."""
    rng = random.Random(seed)
    rows = []
    for i in range(25):
        unit = [rng.choice("ab") for _ in range(rng.randint(1, 30))]
        words = (unit * 60)[: rng.randint(0, 120)]
        if words and rng.random() < 0.5:
            words[rng.randrange(len(words))] = "c"
        rows.append((i, " ".join(words)))
    got = {r[0]: tuple(r)[1:] for r in repeats.remove_repeats(make_docs(rows)).collect()}
    assert got == {k: v for (k, _), v in brute_repeats(rows).items()}


def test_equal_windows_have_equal_anchors():
    words = prose(5, 200).split()
    text = " ".join(words + ["x"] * 7 + words[40:90])
    passages = repeats.Passages(["lead " + text, "", text], 20)
    value, place = passages.anchors()
    flat = [w for ws in passages.words for w in ws]
    seen = {}
    for start, v, p in zip(passages.starts.tolist(), value.tolist(), place.tolist()):
        key = tuple(flat[start : start + 20])
        assert seen.setdefault(key, (v, p - start)) == (v, p - start)


# ---------------------------------------------------------------- pipeline


def similar_components(texts, least=0.8):
    """A component number for each text: links between all pairs of Jaccard similarity ``least`` or more."""
    sets = [frozenset(shingles(t or "").tolist()) for t in texts]
    holders = collections.defaultdict(list)
    for i, own in enumerate(sets):
        for x in own or {None}:
            holders[x].append(i)
    shared = collections.Counter()
    for held in holders.values():
        shared.update((i, j) for k, i in enumerate(held) for j in held[:k])
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for (i, j), both in shared.items():
        if both >= least * (len(sets[i]) + len(sets[j]) - both):
            parent[root(i)] = root(j)
    return [root(i) for i in range(len(texts))]


def template_pages(pages, pairs):
    """Pages of one template, similar by 0.77 to each other, and copies of some that are 0.8 to 0.85 similar."""
    frame = [prose(k, 28) for k in range(12)]
    rng, texts = random.Random(8), []
    for i in range(pages):
        words = " ".join(f"{part} own{i}x{k}a" if k < 8 else part for k, part in enumerate(frame)).split()
        texts.append(words)
    for i in range(pairs):
        words = texts[i * 7 % pages][:]
        for k in rng.sample(range(2, len(words) - 2, 6), 6):
            words[k] = f"edit{i}x{k}"
        texts.append(words)
    return [" ".join(w) for w in texts]


def test_pages_of_one_template(make_docs):
    """A meeting of very many texts that are nearly, but not quite, copies loses no pair."""
    texts = template_pages(400, 60)
    want = similar_components(texts)
    assert 395 < len(set(want)) < 415
    ids = {i: t for i, t in enumerate(texts)}
    kept = [r["doc_id"] for r in keep_one_per_copy(make_docs(list(ids.items()))).collect()]
    first = {}
    for i, c in enumerate(want):
        first.setdefault(c, i)
    assert sorted(kept) == sorted(first.values())


def test_stage_meets_by_simhash(spark, make_docs, monkeypatch):
    """The stage's SimHash step alone joins all copies within its ball, and every pair it names is one."""
    from textquarry.llm import near_copies as stage

    own = [shingles(t) for _, t in near_copies() + near_copies_of_each()]
    prints = [(stage.content_of(s) - (1 << 63), simhash.majority(s) - (1 << 63)) for s in own]
    pairs = stage.ball_pairs(spark.createDataFrame(prints, "content bigint, fp bigint").distinct(), 2).collect()
    roots = brute_components(prints, lambda a, b: ((a[1] ^ b[1]) & (1 << 64) - 1).bit_count() <= 2)
    got = collections.defaultdict(set)
    for a, b in ((r["a"], r["b"]) for r in pairs):
        got[a].add(b), got[b].add(a)
    first = {c: r for (c, _), r in zip(prints, roots)}
    assert pairs and all(first[a] == first[b] for a in got for b in got[a])
    assert {c for c, r in first.items() if list(first.values()).count(r) > 1} == set(got)
    # Without bands it is the only way to meet, and exact copies but for one word still go.
    monkeypatch.setattr(stage, "_elected", lambda met, salts: spark.createDataFrame([], "a bigint, b bigint"))
    monkeypatch.setattr(stage, "_apart", lambda *_: spark.createDataFrame([], "a bigint, b bigint"))
    assert keep_one_per_copy(make_docs(near_copies())).count() < len(near_copies())


def test_prefix_join_loses_no_pair(spark):
    from textquarry.llm import near_copies

    texts = template_pages(150, 50) + [prose(9, 4), prose(9, 4), "", "a b c d e f"]
    own = [shingles(t) for t in texts]
    rows = [(i, i, bytearray(s.tobytes())) for i, s in enumerate(own)]
    pairs = near_copies.prefix_pairs(spark.createDataFrame(rows, "content bigint, _group bigint, shingles binary"), 0.8)
    got = {(r["b"], r["a"]) for r in pairs.collect()}
    want = {(i, j) for j in range(len(own)) for i in range(j) if len(own[i]) and near_copies.jaccard(own[i], own[j]) >= 0.8}
    assert want <= got and len(want) >= 40
    assert len(got) < len(own) * 20  # of some 20,000 pairs


def test_near_copies_keep_clashing_columns(make_docs):
    docs = make_docs([(1, prose(1, 50)), (2, prose(1, 50)), (3, prose(2, 50))]).withColumns(
        {c: lit(7) for c in ("_keep_1", "_keep_2", "_whole", "_id", "_1", "content", "component", "meeting")}
    )
    kept = keep_one_per_copy(docs)
    assert kept.dtypes == docs.dtypes
    assert sorted((r["doc_id"], r["_keep_1"], r["content"]) for r in kept.collect()) == [(1, 7, 7), (3, 7, 7)]


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "secrets", "packing"]
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(corpus_pipeline.materialize(stage(spark, kept[-1], FOLDER), name))
        assert kept[-1].columns == docs.columns
    texts = [r["text"] for r in kept[1].collect()]
    assert kept[2].count() == len(set(similar_components(texts))) < kept[1].count()
    leaks = {r["doc_id"] for r in contamination.find_leaks(kept[2], spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect()}
    assert {r["doc_id"] for r in kept[2].select("doc_id").collect()} - leaks == {r["doc_id"] for r in kept[3].select("doc_id").collect()}
    assert kept[4].count() == kept[3].count()
    assert kept[4].where("text rlike '[0-9a-f]{24}'").count() == 0
    got = corpus_pipeline.run(spark, FOLDER)
    assert {r["doc_id"] for r in got.collect()} == {r["doc_id"] for r in kept[4].collect()}


def test_pipeline_on_odd_rows(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    for name, stage in corpus_pipeline.STAGES:
        for table in (docs, make_docs([])):
            out = stage(spark, table, FOLDER)
            assert name == "packing" or out.columns == docs.columns
            out.count()


def test_bins_are_filled_exactly_while_pieces_last():
    """Best fit misses the bound on tables of very many pieces, where no search gets to its early choices."""
    rng = random.Random(1)
    counts = {n: 1 + int(rng.random() * 120_000 / (n + 400)) for n in range(1, 2049)}
    bound = packing.lower_bound(counts, 2048)
    assert sum(f.bins for f in packing.best_fit_decreasing(counts, 2048)) > bound
    assert check_plan(packing.bin_completion(counts, 2048, max_nodes=0), counts, 2048) == bound
    for seed in range(30):
        rng = random.Random(seed)
        counts = {rng.randint(1, 60): rng.randint(1, 9) for _ in range(rng.randint(1, 25))}
        check_plan(packing.least_waste(counts, 60), counts, 60)


def test_words_go_straight_to_the_merges():
    words = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    every = ["".join(map(chr, range(i, i + 8))) for i in range(0, 256, 8)] + ["'ll", "don't", "résumé", "x²½"]
    got = words.encode_batch(every)
    assert [g.tolist() for g in got] == [words.tokenizer.encode(t, add_special_tokens=False).ids for t in every]

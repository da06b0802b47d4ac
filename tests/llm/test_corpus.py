import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from conftest import DATA, same
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, embeddings, ngram_join, ppm, substrings, toxicity
from tidemark.llm.queries import ORACLES, QUERIES

DOC = "doc_id long, text string, lang string, source string, n_chars long, node int, component_id int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, 1) for i, t in rows], DOC)


@pytest.mark.parametrize("name", ["op2_substring_dedup", "op7_embedding_dedup", "op8_ngram_join"])
def test_query_equals_sql(spark, duck, name):
    assert same(spark, duck, QUERIES[name], ORACLES[name])


def varied(seed, n=60):
    """Texts that share much: copies, edits, cuts, joins, empty and null ones."""
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(40)}" for _ in range(rng.choice((3, 8, 30, 90)))] for _ in range(12)]
    out = [None, "", " \t\n", "one", "one", "two words"]
    while len(out) < n:
        w = list(rng.choice(base))
        kind = rng.randrange(4)
        if kind == 1 and len(w) > 4:
            w[rng.randrange(len(w))] = f"x{rng.randrange(9)}"
        elif kind == 2:
            w = w[rng.randrange(len(w)) :] + rng.choice(base)
        out.append(rng.choice((" ", "\n", "  ")).join(w))
    return list(enumerate(out))


def removed(rows, window):
    first, words = {}, {i: WORD.findall(t or "") for i, t in rows}
    for i, w in sorted(words.items()):
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    out = {}
    for i, w in words.items():
        gone = {k + j for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < i for j in range(window)}
        out[i] = [x for k, x in enumerate(w) if k not in gone]
    return words, out


@pytest.mark.parametrize(("seed", "window", "crowd"), [(1, 13, 4096), (2, 3, 4096), (3, 5, 2), (4, 1, 4096)])
def test_substrings_by_brute_force(spark, seed, window, crowd):
    rows = varied(seed)
    words, kept = removed(rows, window)
    got = {r.doc_id: r for r in substrings.substring_digest(docs(spark, rows), window, crowd).collect()}
    assert {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in got.items()} == {
        i: (len(w), len(w) - len(kept[i]), hashlib.sha256(" ".join(kept[i]).encode()).hexdigest()) for i, w in words.items()
    }


def test_substrings_of_null_ids_and_of_nothing(spark):
    text = " ".join(f"w{i}" for i in range(20))
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in substrings.substring_digest(docs(spark, [(None, text), (7, text), (None, text)])).collect())
    assert got == [("7", 20, 0), ("None", 20, 20), ("None", 20, 20)]
    assert substrings.substring_digest(docs(spark, [])).count() == 0


def test_remove_repeats_keeps_columns_and_rows(spark):
    rows = varied(5) + [(7, varied(5)[7][1])]
    _, kept = removed(varied(5), 5)
    out = substrings.remove_repeats(docs(spark, rows), 5)
    assert out.columns == docs(spark, rows).columns
    for r in out.collect():
        same_text = dict(varied(5))[r.doc_id]
        assert WORD.findall(r.text or "") == kept[r.doc_id] and (r.text == same_text or r.n_chars == len(r.text))
    assert out.count() == len(rows) and substrings.remove_repeats(docs(spark, [])).count() == 0


def test_remove_spans_of_a_reference(spark):
    ref = docs(spark, [(1, "a b c d e f"), (2, None), (3, "q r s t")])
    got = {r.doc_id: r.n_removed for r in substrings.remove_spans(docs(spark, [(1, "x a b c d y"), (2, "r s t u q r s"), (3, None)]), ref, 3, shard=4).collect()}
    assert got == {1: 4, 2: 6, 3: 0}
    with pytest.raises(ValueError):
        substrings.remove_spans(ref, ref, 3, most=1)


def shingles(t, n):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in WORD.findall(t or "")]
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def grouped(rows, n, num, den):
    sets = {i: shingles(t, n) for i, t in rows}
    low = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                    low[a] = low[b] = min(low[a], low[b])
    return sets, low


@pytest.mark.parametrize(("seed", "n", "num", "den"), [(1, 4, 85, 100), (2, 2, 60, 100), (3, 5, 80, 100), (6, 1, 50, 100)])
def test_join_by_brute_force(spark, seed, n, num, den):
    rows = varied(seed)
    sets, low = grouped(rows, n, num, den)
    placed, _ = ngram_join.similar_documents(docs(spark, rows), n, num, den)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in placed.collect()} == {i: (len(s), low[i]) for i, s in sets.items()}
    kept = ngram_join.drop_similar(docs(spark, rows + rows[9:12]), n, num, den)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in sets if low[i] == i) and kept.columns == docs(spark, []).columns


def test_join_of_null_and_repeated_ids(spark):
    text = lambda k, odd=None: " ".join("odd" if i == odd else f"{k}w{i}" for i in range(60))
    rows = [(None, text("a")), (None, text("a", 0)), (None, text("a", 59)), (None, "lone text without any copy"), (3, text("b")), (None, text("b", 0))]
    # Only the null id's set links 10 with 11; 20 stands for two texts, one of which belongs to 5; 30 repeats a near copy of itself.
    c = [f"c{i}" for i in range(80)]
    rows += [(10, " ".join(c)), (None, " ".join(["x"] * 7 + c[7:])), (11, " ".join(["x"] * 7 + c[7:73] + ["y"] * 7))]
    rows += [(5, text("d")), (20, text("d", 0)), (20, text("e")), (30, text("f")), (30, text("f", 0)), (None, None), (None, None), (None, ""), (40, ""), (40, text("g"))]
    placed, _ = ngram_join.similar_documents(docs(spark, rows), 4, 85, 100)
    got = {}
    for r in placed.collect():
        got.setdefault(r.component_id, []).append(r.doc_id)
    assert {k: sorted(v, key=str) for k, v in got.items()} == {None: [None] * 7, 3: [3, None], 5: [20, 5], 10: [10, 11, None], 20: [20], 30: [30, 30], 40: [40, 40]}
    kept = [(r.doc_id, r.text) for r in ngram_join.drop_similar(docs(spark, rows), 4, 85, 100).collect()]
    ids = sorted((i for i, _ in kept if i is not None))
    assert ids == [3, 5, 10, 20, 30, 40, 40] and (20, text("e")) in kept
    nulls = [t for i, t in kept if i is None]
    assert len(nulls) == 4 and {None, "", "lone text without any copy"} < set(nulls) and any((t or "").endswith(" aw58 aw59") or (t or "").startswith("aw0 aw1") for t in nulls)


def test_chain_of_links_is_one_component(spark):
    w = [f"w{i}" for i in range(60)]
    rows = [(k, " ".join([f"n{j}" for j in range(3 * k)] + w[3 * k :])) for k in range(15)]
    sets, low = grouped(rows, 4, 85, 100)
    placed, _ = ngram_join.similar_documents(docs(spark, rows), 4, 85, 100)
    assert {r.doc_id: r.component_id for r in placed.collect()} == low and len(set(low.values())) < 15


def test_join_of_nothing(spark):
    assert ngram_join.similar_documents(docs(spark, []))[0].count() == 0 and ngram_join.drop_similar(docs(spark, [])).count() == 0


def test_signatures_meet_within_the_limit():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(400):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[int(len(a) * 0.07) :], rng.integers(0, 2**63, int(len(a) * 0.07)).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(a) != both and 100 * both >= 85 * (len(a) + len(b) - both):
            assert set(ngram_join.signatures(a, 85, 100)) & set(ngram_join.signatures(b, 85, 100))


def test_sketches_bound_differences():
    import numpy as np

    rng = np.random.default_rng(4)
    for n, m in ((50, 60), (300, 900), (2000, 2100)):
        a, b = (np.unique(rng.integers(0, 2**62, k).astype(np.uint64)) for k in (n, m))
        x = ngram_join.folded([ngram_join.sketch(a), ngram_join.sketch(b)])
        assert np.bitwise_count(x[0] ^ x[1]).sum() <= len(np.setxor1d(a, b))


def tokens(t):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(t or "")] + ["\0end"]


@pytest.mark.parametrize("crowd", [1, 30, ppm.CROWD])  # no pair of bytes is crowded, some are, all are
def test_ppm_by_brute_force(spark, crowd):
    rows = [(1, "the cat sat on the mat"), (2, "the dog sat"), (3, None), (4, ""), (5, "Zürich the Cat  sat"), (6, "a a a a a a"), (7, "xyz the"), (8, "the catalog"), (8, "the catalog")]
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    marked = lambda t: [255] * ppm.ORDER + list(re.sub(b"[A-Z]", lambda m: m[0].lower(), (t or "").encode())) + [254]
    seen = [collections.defaultdict(collections.Counter) for _ in range(ppm.ORDER + 1)]
    words = collections.Counter()
    for i, t in rows:
        if not held[i]:
            words.update(tokens(t))
            s = marked(t)
            for p in range(ppm.ORDER, len(s)):
                for o in range(ppm.ORDER + 1):
                    seen[o][tuple(s[p - o : p])][s[p]] += 1

    def log10(s, p):
        out, gone = 0.0, set()
        for o in range(ppm.ORDER, -1, -1):
            c = seen[o].get(tuple(s[p - o : p]), {})
            total, kinds = sum(n for b, n in c.items() if b not in gone), len(set(c) - gone)
            if s[p] in c:
                return out + math.log10(c[s[p]] / (total + kinds))
            out += math.log10(kinds / (total + kinds)) if kinds else 0.0
            gone |= set(c)
        return out - math.log10(256 - len(gone))

    n, v = sum(words.values()), len(words)
    got = ppm.score_documents(docs(spark, rows), F.crc32(F.col("doc_id").cast("string")) % 7 == 2, crowd).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
    for r in got:
        t, s = dict(rows)[r.doc_id], marked(dict(rows)[r.doc_id])
        assert r.score == pytest.approx(sum(log10(s, p) for p in range(ppm.ORDER, len(s))), abs=1e-4)
        assert r.base_score == pytest.approx(sum(math.log10((words[w] + 1) / (n + v + 1)) for w in tokens(t)))
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(tokens(t)), sum(words[w] > 0 for w in tokens(t)), n)
    assert ppm.score_documents(docs(spark, []), F.lit(False)).count() == 0
    nulls = [r for r in ppm.score_documents(docs(spark, [(None, "the cat"), (None, "the cat"), (1, "the cat")]), F.crc32(F.col("doc_id").cast("string")) % 7 == 2).collect()]
    assert sorted(map(str, (r.doc_id for r in nulls))) == ["1", "None", "None"] and not any(r.held_out for r in nulls if r.doc_id is None)


def test_ppm_is_a_distribution():
    import numpy as np

    text = b"abracadabra abracadabra"
    keys, _ = ppm.byte_grams(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    pairs = np.zeros((256, 256), np.int64)
    np.add.at(pairs, ((keys >> np.uint64(8)) & np.uint64(255), keys & np.uint64(255)), 1)
    known, counts = np.unique(keys, return_counts=True)
    for context in (b"dabra", b"xxabr", b"zzzzz"):
        asked = np.array([int.from_bytes(context + bytes([c]), "big") for c in range(256)], np.uint64)
        assert 0.9 < (10 ** ppm.log_probabilities(asked, known, counts, pairs)).sum() <= 1 + 1e-9


def test_held_out_texts_score_better_than_words(spark):
    r = QUERIES["op4_ppm_scores"](spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_bytes")).first()
    assert -r[0] / r[2] * math.log2(10) < 3.2


MARKS = re.compile(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def test_decontamination_by_brute_force(spark):
    split = lambda t: [w for w in MARKS.split((t or "").lower().replace("ß", "ss")) if w]
    d, b = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    items = {r.item_id: split(r.text) for r in b.collect()}
    want = {}
    for r in d.collect():
        w = split(r.text)
        for i, x in items.items():
            own = {tuple(x[k : k + 5]) for k in range(len(x) - 4)}
            grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
            if own & set(grams):
                best = max((len(own & set(grams[k : k + len(x) - 4])) / len(own | set(grams[k : k + len(x) - 4])) for k in range(len(w) - len(x) + 1)), default=0)
                if best >= 0.8:
                    want[(r.doc_id, i)] = best
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(d, b).collect()}
    assert set(got) == set(want) and got


def weighted_matches(texts, items, threshold=0.8):
    """(doc_id, item_id) -> (start, n_words, similarity) of every document and item, by all windows and sums over multisets."""
    split = lambda t: [w for w in MARKS.split((t or "").lower().replace("ß", "ss")) if w]
    grams = lambda w, k: collections.Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    own = {i: split(t) for i, t in items.items() if t is not None}
    sets = {i: grams(w, min(5, len(w))) for i, w in own.items() if w}
    have = collections.Counter(g for x in sets.values() for g in x)
    weight = lambda g: math.log(1 + len(own) / max(1, have[g]))
    found = {}
    for doc, text in texts.items():
        words = split(text)
        every = {k: set(grams(words, k)) for k in range(1, 6)}
        for i, theirs in sets.items():
            k, n = min(5, len(own[i])), min(len(own[i]), len(words))
            if not every[k].intersection(theirs):
                continue
            for at in range(len(words) - n + 1):
                mine = grams(words[at : at + n], k)
                s = sum(weight(g) * c for g, c in (mine & theirs).items()) / sum(weight(g) * c for g, c in (mine | theirs).items())
                if s >= threshold - 1e-12 and s > found.get((doc, i), (0, 0, 0.0))[2] + 1e-9:
                    found[(doc, i)] = (at, n, s)
    return found


def test_weighted_decontamination_by_brute_force(spark):
    rng = random.Random(23)
    words = [f"v{i}" for i in range(40)]
    items = {i: " ".join(rng.choices(words, k=rng.choice([3, 5, 8, 20, 30]))) for i in range(25)}
    items |= {25 + i: " ".join(["shared wording of several items here"] + rng.choices(words, k=14)) for i in range(6)}
    items |= {31: None, 32: ""}
    texts = {}
    for d in range(300):
        part = items[rng.randrange(31)].split()
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            at = rng.randrange(len(part))
            part[at : at + rng.choice([0, 1])] = ["odd"] if rng.random() < 0.7 else []
            part = part or ["odd"]
        texts[d] = " ".join(rng.choices(words, k=rng.randrange(9)) + part + rng.choices(words, k=rng.randrange(9)))
    b = spark.createDataFrame(list(items.items()), "item_id long, text string")
    want = weighted_matches(texts, items)
    got = {(r.doc_id, r.item_id): (r.start, r.n_words, r.similarity) for r in decontaminate.contaminated(docs(spark, list(texts.items())), b).collect()}
    assert set(got) == set(want) and len(want) > 100 and any(s < 1 for _, _, s in want.values())
    assert all(got[k][1:] == pytest.approx(want[k][1:]) and got[k][0] == want[k][0] for k in want)


def test_decontamination_cases(spark):
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    b = spark.createDataFrame([(1, item, 0), (2, "tiny item here", 0), (3, None, 0), (4, "", 0), (5, item, 0)], "item_id long, text string, doc_id int")
    words = item.split()
    rows = [(1, f"before {item.upper()}, after"), (2, " ".join(words[:-1])), (3, "x " * 50), (4, None), (5, ""), (6, "A TINY, item: here!"), (7, " ".join(words[:9] + ["odd"] + words[10:])), (8, (f"{item} filler text " * 3)), (None, item)]
    got = {(r.doc_id, r.item_id): round(r.similarity, 6) for r in decontaminate.contaminated(docs(spark, rows), b).collect()}
    assert {k for k, s in got.items() if s == 1} == {(1, 1), (1, 5), (6, 2), (8, 1), (8, 5), (None, 1), (None, 5)} and got[(2, 1)] == got[(2, 5)] == 0.9375 and not {3, 4, 5, 7} & {k[0] for k in got}
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(docs(spark, rows), b).collect()) == [3, 4, 5, 7]
    odd = spark.createDataFrame([(None, item), (-1, item)], "item_id long, text string")
    assert sorted(map(str, (r.item_id for r in decontaminate.contaminated(docs(spark, rows[:1]), odd).collect()))) == ["-1", "None"]
    clean = [(None, "x " * 50), (1, "quite another text"), (None, None), (1, "")]
    assert sorted(map(str, ((r.doc_id, r.text) for r in decontaminate.drop_contaminated(docs(spark, [r for r in rows if r[0] in (None, 1)] + clean), b).collect()))) == sorted(map(str, clean))
    assert decontaminate.contaminated(docs(spark, []), b).count() == 0 and decontaminate.contaminated(docs(spark, rows), b.limit(0)).count() == 0


def test_documents_shorter_than_the_item(spark):
    words = [f"w{i}" for i in range(20)]
    b = spark.createDataFrame([(1, " ".join(words)), (2, "a b c d e")], "item_id long, text string")
    rows = [(1, " ".join(words[:-1])), (2, " ".join(words[2:])), (3, " ".join(words[:15])), (4, "a b c d"), (5, " ".join(words[:17]))]
    got = {(r.doc_id, r.item_id): (r.start, r.n_words, round(r.similarity, 6)) for r in decontaminate.contaminated(docs(spark, rows), b).collect()}
    assert got == {(1, 1): (0, 19, 0.9375), (2, 1): (0, 18, 0.875), (5, 1): (0, 17, 0.8125)}
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(docs(spark, rows), b).collect()) == [3, 4]


def test_weights_do_not_depend_on_blocks(spark, monkeypatch):
    rng = random.Random(11)
    common = [f"c{i}" for i in range(20)]
    texts = [" ".join(common + [f"u{k}x{i}" for i in range(12)]) for k in range(6)]
    edited = [t.split() for t in texts]
    for w in edited:
        w[rng.randrange(3, 9)] = "odd"
    # The last document holds wording that only items of other blocks have.
    rows = [(k, " ".join(w)) for k, w in enumerate(edited)] + [(9, " ".join(texts[0].split()[:-1] + ["u5x0"] + texts[1].split()))]
    b = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    found = lambda: {(r.doc_id, r.item_id): (r.start, round(r.similarity, 9)) for r in decontaminate.contaminated(docs(spark, rows), b, 0.5).collect()}
    want = found()
    for words in (1, 70, 130):
        monkeypatch.setattr(decontaminate, "BLOCK", words)
        assert found() == want and want


def test_blocks_find_all_within_the_radius():
    import numpy as np

    rng = np.random.default_rng(5)
    items = decontaminate.Items(list(range(40)), [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 30)) for _ in range(40)], 0.8)
    for distance in (0, 20, 63):
        bits = items.bits[7].copy()
        bits[rng.choice(256, distance, replace=False)] ^= True
        assert (0, 7) in set(items.within(bits[None]))


def test_folding():
    assert toxicity.fold("Ｓｔüｐｉｄ  1D10T​ сlоwn, Straße") == "stupid idiot ciown strasse"
    assert toxicity.fold(None) == "" and toxicity.fold("...") == ""


def test_exception_phrases_and_length():
    found = toxicity.lexicon_automaton({"trash": 3.0, "vequ*": 2.0, "vequto": 5.0}, {"trash can"})
    assert toxicity.features("the trash can", found)[0] == 0 and toxicity.features("trash trash can", found)[0] == 3 / 22
    assert toxicity.features("vequto vequx trashy xvequ", found)[0] == 7 / 23
    assert toxicity.features("trash", found)[0] > toxicity.features("trash" + " x" * 50, found)[0]


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    r = QUERIES["op6_toxicity"](spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    n = {(x.toxic, x.predicted): x.n for x in r.groupBy("toxic", "predicted").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert n[(1, 1)] >= 0.85 * (n[(1, 1)] + n.get((1, 0), 0)) and n.get((0, 1), 0) <= 0.01 * n[(0, 0)]


def test_toxicity_scores_by_brute_force(spark):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(d, labels, F.lit(True))
    weights, exceptions, (b0, b1, b2) = model
    assert weights
    rows = d.join(labels, "doc_id").select("doc_id", "text", "toxic").collect()
    texts = {(r.text, r.toxic) for r in rows if r.toxic is not None and r.text is not None}
    own = {w: [0, 0] for w in weights}
    total = [0, 0]
    for text, toxic in texts:
        words = toxicity.fold(text).split()
        total[toxic] += 1
        for w in own:
            own[w][toxic] += any(x.startswith(w[:-1]) and len(x) > len(w) - 1 if w.endswith("*") else x == w for x in words)
    for w, (good, bad) in own.items():
        assert weights[w] == pytest.approx(math.log((bad + 0.5) / (total[1] + 1)) - math.log((good + 0.5) / (total[0] + 1)))
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(d, model).collect()}
    for r in d.collect():
        words = toxicity.fold(r.text).split()
        sums = 0.0
        for i, x in enumerate(words):
            quiet = " ".join(words[i : i + 2]) in exceptions or i and " ".join(words[i - 1 : i + 1]) in exceptions
            hits = [v for w, v in weights.items() if (x.startswith(w[:-1]) if w.endswith("*") else x == w)]
            sums += max(hits, default=0.0) if not quiet else 0.0
        z = b0 + b1 * sums / (max(0, len(words) - 1) + 20) + b2 * math.log1p(sums)
        assert got[r.doc_id] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


def test_toxicity_cases(spark):
    rng = random.Random(1)
    text = lambda i: " ".join(rng.choice("abcdefgh") * 4 for _ in range(20)) + (" horrid" if i % 4 == 0 else "")
    rows = [(i, text(i)) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0), 0) for i in range(200)] + [(9999, 1, 0), (3, None, 0)], "doc_id long, toxic int, text int")
    model = toxicity.learn(docs(spark, rows), labels, F.lit(True))
    new = docs(spark, [(1, "HORR1D thing"), (2, "a nice thing"), (3, None), (4, ""), (None, "нorrid")])
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(new, model).collect()}
    assert got[1] > 0.5 and got[None] > 0.5 and max(got[2], got[3], got[4]) < 0.5
    assert sorted(r.doc_id for r in toxicity.drop_toxic(new, labels.limit(0)).collect() if r.doc_id) == [1, 2, 3, 4]
    assert toxicity.score_toxicity(docs(spark, []), model).count() == 0


def test_embeddings_by_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(7)
    base = rng.normal(size=(40, 16))
    x = [(base[i % 40] + rng.normal(scale=rng.choice([0.02, 0.07, 0.12]), size=16)).tolist() for i in range(400)]
    x += [(base[0] + rng.normal(scale=0.02, size=16)).tolist() for _ in range(60)] + [x[0]] * 5 + [[2 * v for v in x[1]]]
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0, 2.0]]
    rows = [(i, v, 1) for i, v in enumerate(x + odd)]
    log = []
    got = {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, component_id int"), log=log).collect()}
    u = np.array(x) / np.linalg.norm(x, axis=1)[:, None]
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    low = np.arange(len(x))
    for _ in range(60):
        low = np.minimum(low, np.where(near, low[None, :], len(x)).min(1))
    assert [got[i].n_links for i in range(len(x))] == near.sum(1).tolist() and [got[i].component_id for i in range(len(x))] == low.tolist()
    assert all(got[i].n_links == 0 and got[i].kept for i in range(len(x), len(rows))) and log[-1][1] >= 0.995
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_links_between_tight_clusters(spark):
    import numpy as np

    rng = np.random.default_rng(9)

    def near(a, cos):
        b = rng.normal(size=16)
        b -= (a @ b) * a
        return cos * a + math.sqrt(1 - cos * cos) * b / np.linalg.norm(b)

    x = []
    # Two clusters, three in a chain of which one is larger than a window, and one alone.
    for sizes in ((40, 40), (30, 400, 30), (50,)):
        c = rng.normal(size=16)
        c /= np.linalg.norm(c)
        for n in sizes:
            x += [c + rng.normal(scale=1e-4, size=16) for _ in range(n)]
            c = near(c, 0.96)
    x = np.array(x)[rng.permutation(len(x))]
    u = x / np.linalg.norm(x, axis=1)[:, None]
    links = u @ u.T >= 0.95
    np.fill_diagonal(links, False)
    low = np.arange(len(x))
    for _ in range(10):
        low = np.minimum(low, np.where(links, low[None, :], len(x)).min(1))
    got = {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")).collect()}
    assert [got[i].n_links for i in range(len(x))] == links.sum(1).tolist() and [got[i].component_id for i in range(len(x))] == low.tolist()
    assert sum(r.kept for r in got.values()) == len(set(low.tolist())) == 3


def test_pipeline_by_its_parts(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, DATA)
    assert {"doc_id", "text", "source", "copy"} <= set(out.columns)
    rows = out.collect()
    assert rows and len({r.doc_id for r in rows}) <= 200
    texts = list({r.doc_id: r.text for r in rows}.items())
    _, low = grouped(texts, 5, 80, 100)
    assert sum(low[i] == i for i in low) >= 0.98 * len(low)
    words, kept = removed(texts, corpus_pipeline.PASSAGE)
    assert all(len(kept[i]) == len(w) for i, w in words.items())
    bad = decontaminate.contaminated(out, spark.read.parquet(f"{DATA}/benchmark.parquet"))
    assert bad.count() == 0 and [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity"


CLASHES = DOC.replace("node int, component_id int", "node int, component_id int, copy int, size int, toxic int, item_id int, target int, weight int, start int, n_words int")


def clashing(spark, rows):
    """Rows with a null in every column but those given, and columns that the operators use as names."""
    return spark.createDataFrame([(i, t, None, s, None, *[1] * 10) for i, t, s in rows], CLASHES)


def stage_folder(spark, tmp_path, rows):
    base = [f"base{i}" for i in range(60)]
    item = " ".join(f"item{i}" for i in range(20))
    long = " ".join(f"{random.Random(4).random()}x{i}" for i in range(30_000))
    given = [(1, " ".join(base), "a"), (1, " ".join(base), "a"), (2, " ".join([*base, "extra"]), "b"), (None, " ".join(base), "a"), (3, None, None)]
    given += [(4, "", "a"), (5, None, "b"), (6, long, None), (None, "other short words here now", "b"), (7, f"before {item} after", "a")]
    clashing(spark, given if rows else []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None, 0), (None, 1, 0), (2, 1, None), (99, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    import corpus_pipeline as p

    folder = stage_folder(spark, tmp_path, True)
    given = spark.read.parquet(f"{folder}/documents.parquet")
    every = [1, 1, 2, 3, 4, 5, 6, 7, None, None]
    ids = lambda df: sorted((r.doc_id for r in df.collect()), key=lambda i: (i is None, i))
    assert all(stage(spark, given, folder).columns == list(p.COLUMNS) for _, stage in p.STAGES[:-1])
    assert ids(p.toxicity(spark, given, folder)) == every
    assert ids(p.similar(spark, given, folder)) == [1, 3, 4, 5, 6, 7, None]
    assert ids(p.benchmark(spark, given, folder)) == [1, 1, 2, 3, 4, 5, 6, None, None]
    cut = p.passages(spark, given, folder)
    assert ids(cut) == every and {r.doc_id: r.text for r in cut.where("doc_id in (2, 3, 4)").collect()} == {2: "extra", 3: None, 4: ""}
    assert len(cut.where("doc_id = 6").first().text.split()) == 30_000
    mixed = p.mixing(spark, given, folder).collect()
    assert {r.source for r in mixed} <= {"a", "b", None} and 30_000 in {r["size"] for r in mixed}
    assert all(0 < r.copy <= 2 for r in mixed) and mixed


def test_pipeline_of_odd_rows_and_of_none(spark, tmp_path):
    import corpus_pipeline as p

    rows = p.run(spark, stage_folder(spark, tmp_path / "some", True)).collect()
    # 2 is like 1, and 7 holds an item; documents without words have size 0 and are taken as often as others of their source.
    assert {r.doc_id for r in rows} <= {1, 3, 4, 5, 6, None} and {1, 6} <= {r.doc_id for r in rows}
    none = p.run(spark, stage_folder(spark, tmp_path / "none", False))
    assert none.columns == [*p.COLUMNS, "size", "source_size", "target", "copy"] and none.count() == 0


def test_families_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    rng = random.Random(8)
    shared = [[f"p{k}w{i}" for i in range(40)] for k in range(3)]
    rows = [(i, " ".join(rng.choice(shared) + [f"d{i // 3}x{j}" for j in range(rng.choice((12, 30)))] + ([f"y{i}"] if i % 2 else []))) for i in range(70)]
    rows += [(100 + i, t) for i, t in varied(9)]
    for n, num, den in ((4, 85, 100), (5, 80, 100), (2, 60, 100)):
        sets, low = grouped(rows, n, num, den)
        placed, _ = ngram_join.similar_documents(docs(spark, rows), n, num, den)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in placed.collect()} == {i: (len(s), low[i]) for i, s in sets.items()}


def test_a_recall_that_stays_low_is_an_error(spark, monkeypatch):
    rng = random.Random(2)
    x = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(40)]
    rows = [(i, [y + rng.gauss(0, 0.01) for y in x[i % 20]]) for i in range(40)]
    monkeypatch.setattr(embeddings, "TARGET", 1.5)
    monkeypatch.setattr(embeddings, "AUDITS", 2)
    log = []
    with pytest.raises(RuntimeError, match="recall"):
        embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), log=log)
    assert [a for a, _ in log] == [0, 1]


def test_components_by_union_find(spark):
    from tidemark.llm.graphs import components, cut, drop_cut

    ids = list(range(-150, 150))
    rng = random.Random(3)
    rng.shuffle(ids)
    edges = list(zip(ids, ids[1:100])) + [(ids[200], x) for x in ids[201:260]] + [(7, 7)] + list(zip(ids[270:], ids[271:])) * 2
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = top(u), top(v)
            root[max(a, b)] = min(a, b)
    given = spark.createDataFrame(edges, "u long, v long").repartition(5)
    assert sorted(map(tuple, components(given).collect())) == sorted((x, top(x)) for x in root)
    assert components(given.limit(0)).count() == 0
    first = cut(given)
    second = cut(first.groupBy("u").count())
    drop_cut(first)
    assert second.count() == len({u for u, _ in edges})

"""Cross-tokenizer alignment, ranked lexical search and circulant MinHash on odd rows, against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from compare import rows

from hillframe.llm import alignment, circulant, lexical

public_tokenizers = pytest.importorskip("public_tokenizers")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BASE = [f"word{i * 7919 % 991}" for i in range(400)]
TEXTS = [
    None, "", "   \n ", "one", "one", "It's  a\ttest\n\n  of 日本 été 😀‍ and 龘\x00x <|endoftext|> </s>", "has ▁ mark", " leading", "trailing  ", "a　b c\x1cd e\x85f", "é á ́b", " ".join(BASE), " ".join(BASE).upper(),
    " ".join("edited" if i == 200 else w for i, w in enumerate(BASE)), "x" * 9000, "ß" * 700 + " end", "tab\tand \r\n line", "   many    spaces     here", "日本語のテキスト 中文 한국어", "short words here now", "!!! ??? #$% ... '' 's 've",
]
SCHEMA = "doc_id long, text string, links string, kind int, `a.b` string"


@pytest.fixture(scope="module")
def odd(spark):
    data = [(i, t, "x", 3, "y") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*data, data[11], (None, "one", "x", 3, "y")], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def whole_tokens(text):
    """Ids and byte ends of both sides by whole texts and decoded bytes alone; None where bytes differ."""
    a, b = alignment.sides(A, B)
    raw, out = (" " + text).encode(), []
    for ids, table in ((a.tokenizer.encode(" " + text, add_special_tokens=False).ids, a.bytes), (b.model.encode(text), b.bytes)):
        if b"".join(table[i] for i in ids) != raw:
            return None
        out.append((ids, np.cumsum([len(table[i]) for i in ids]).tolist()))
    return out


def plain_alignment(texts):
    docs = []
    for text in texts:
        found = whole_tokens(text) if text else None
        if not found:
            docs.append((0, 0, 0, "", []))
            continue
        (ia, ea), (ib, eb) = found
        ends, groups, links, p, q = sorted(set(ea) & set(eb)), [], [], 0, 0
        for end in ends:
            x, y = ea.index(end, p) + 1, eb.index(end, q) + 1
            groups.append(",".join(map(str, ia[p:x])) + "|" + ",".join(map(str, ib[q:y])))
            links.append((ia[x - 1], ib[y - 1]))
            p, q = x, y
        docs.append((len(ia), len(ib), len(ends), ";".join(groups), links))
    count = Counter(link for d in docs for link in d[4])
    most = defaultdict(int)
    for (_, y), c in count.items():
        most[y] = max(most[y], c)
    return [(d[0], d[1], d[2], d[3], len(d[4]), sum(count[x] == most[x[1]] for x in d[4]), sum(count[x] for x in d[4])) for d in docs]


def test_alignment_equals_whole_texts(odd):
    given = odd.select("doc_id", "text").collect()
    want = sorted(((r[0], *x) for r, x in zip(given, plain_alignment([r[1] for r in given]), strict=True)), key=repr)
    columns = ("doc_id", "n_a", "n_b", "n_groups", "groups", "n_links", "n_best", "count_sum")
    for most in (3_000_000, 0):  # by broadcast, and by the join
        got = [tuple(r[c] for c in columns) for r in alignment.aligned(odd, A, B, most_pairs=most).collect()]
        assert sorted(got, key=repr) == want
    digests = {(r["doc_id"], r["groups"]) for r in alignment.aligned(odd, A, B, digest=True).collect()}
    assert digests == {(w[0], hashlib.sha256(w[4].encode()).hexdigest() if w[4] else "") for w in want}
    assert sum(w[1] == 0 for w in want) == 3  # null, empty and the space mark


def test_alignment_units_equal_whole_texts_at_random():
    pick = random.Random(5)
    alphabet = list("ab Z9'.,-\n\t  ") + ["é", "ß", "日", "本", "😀", "　", "\xa0", "́", "\x00", "\x1c", " the", " and", "'s", "\r\n", " ", "\U00020bb7"]
    texts = ["".join(pick.choice(alphabet) for _ in range(pick.randint(1, 60))) for _ in range(1500)]
    units = alignment.Units(*alignment.sides(A, B))
    assert units.cuts
    for text, (na, nb, ng, groups, *_) in zip(texts, plain_alignment(texts), strict=True):
        own = units.numbers_of(alignment.UNIT.split(" " + text))
        if not units.whole[own].all():
            assert not groups
            continue
        assert (*units.n[own].sum(axis=0), ";".join(units.groups[i] for i in own)) == (na, nb, ng, groups)


def test_alignment_memory_is_bounded():
    units = alignment.Units(*alignment.sides(A, B), most_bytes=1000)
    units.numbers_of([f" w{i}" for i in range(50)])
    assert units.full()
    units.times += 1
    units.thin_out()
    assert not units.full() and not units.index and not len(units.pair_counts()[0])


def test_alignment_keeps_frequent_units():
    units = alignment.Units(*alignment.sides(A, B), most_bytes=3000)
    names = [f" word{i}é" for i in range(30)]
    of = units.numbers_of(names)
    units.times[of[[3, 17]]] += 2
    whole = [(units.groups[i], units.n[i].tolist()) for i in of[[3, 17]]]
    units.thin_out()
    assert list(units.index) == [names[3], names[17]]
    assert [(units.groups[i], units.n[i].tolist()) for i in (0, 1)] == whole and len(units.links) == units.n[:, 2].sum()
    assert units.numbers_of([names[17], names[0]]).tolist() == [1, 2]


def plain_search(docs, items, top):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = [(i, Counter(term.findall((t or "").translate(fold)))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in found]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for (i, c), size in zip(found, sizes, strict=True):
            if i is None or not size:
                continue
            m = 50 + 50 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(term.findall((text or "").translate(fold))) if c[t])
            if s > 0:
                scores.append((-s, i))
        out += [(item, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:top])]
    return out


@pytest.mark.parametrize("block", [50_000, 6])
def test_search_equals_plain_search(spark, odd, block):
    items = spark.createDataFrame([(1, "word5 WORD10 word15"), (2, "one"), (3, None), (4, "..."), (5, "nowhere"), (6, " ".join(BASE[:60])), (7, "日本 x of it s"), (7, "here now")], "item_id long, text string")
    got = lexical.ranked_search(odd, items, top=4, block_terms=block).select("item_id", "rank", "doc_id", "score").collect()
    want = plain_search([tuple(r) for r in odd.select("doc_id", "text").collect()], [tuple(r) for r in items.collect()], 4)
    assert sorted(map(tuple, got)) == sorted(want)


def test_search_of_nothing(none, odd, spark):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert lexical.ranked_search(none, items).count() == 0
    assert lexical.ranked_search(odd, items.where("false")).count() == 0


def test_intervals_are_left_out_and_results_whole():
    make = np.random.default_rng(3)
    size, terms = 2000, 40
    doc, term = np.nonzero(make.random((size, terms)) < make.random(terms) * 0.3)
    impact = make.integers(1, 50, len(doc)) * 1000
    few = make.permutation(size)[:60]  # documents that hold all
    doc, term, impact = np.concatenate([doc, np.repeat(few, terms)]), np.concatenate([term, np.tile(np.arange(terms), 60)]), np.concatenate([impact, np.full(60 * terms, 60_000)])
    one = np.unique(doc * terms + term, return_index=True)[1]
    doc, term, impact = doc[one].astype(np.int64), term[one].astype(np.int64), impact[one].astype(np.int64)
    first, own = np.array([0, terms, terms + 5]), np.concatenate([np.arange(terms), np.arange(5)])
    best = lexical.Best(2, 50)
    scored = lexical.search_shard(best, first, own, np.arange(size), doc, term, impact)
    for item, asked in ((0, np.arange(terms)), (1, np.arange(5))):
        total = np.bincount(doc, impact * np.isin(term, asked), size).astype(np.int64)
        order = np.lexsort((np.arange(size), -total))[:50]
        assert best.doc[best.item == item].tolist() == order.tolist() and best.score[best.item == item].tolist() == total[order].tolist()
    assert scored < 2 * size


def plain_classes(docs, k, numerator):
    sets = []
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets.append((i, {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()))
    label = list(range(len(sets)))
    for _ in sets:
        for x, (_, s) in enumerate(sets):
            for y, (_, t) in enumerate(sets):
                if s and t and 100 * len(s & t) >= numerator * len(s | t):
                    label[x] = label[y] = min(label[x], label[y])
    ids = defaultdict(list)
    for (i, _), c in zip(sets, label, strict=True):
        ids[c] += [] if i is None else [i]
    return [(i, len(s), min(ids[c]) if ids[c] else None, i == (min(ids[c]) if ids[c] else None)) for (i, s), c in zip(sets, label, strict=True)]


def test_minhash_equals_plain_classes(spark, odd, none):
    pick = random.Random(2)
    chain = [list(BASE[:120])]
    for _ in range(12):  # each is near the last one, the first and the last are far apart
        chain.append([f"n{pick.random()}" if pick.random() < 0.01 else w for w in chain[-1]])
    paragraphs = [[f"p{p}w{i}" for i in range(30)] for p in range(8)]
    mixed = [[w for p in pick.sample(paragraphs, 5) for w in p] for _ in range(30)]
    more = [(100 + i, " ".join(w), "x", 3, "y") for i, w in enumerate(chain + mixed)]
    table = odd.unionByName(spark.createDataFrame(more, SCHEMA))
    got = circulant.minhash_components(table, k=5, numerator=85).select("doc_id", "n_shingles", "class_id", "kept").collect()
    want = plain_classes([tuple(r) for r in table.select("doc_id", "text").collect()], 5, 85)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert circulant.minhash_components(none).count() == 0


def test_circulant_coordinates_and_their_agreement():
    make = np.random.default_rng(1)
    a = make.integers(0, 2**63, 1000, dtype=np.uint64)
    b = np.concatenate([a[:900], make.integers(0, 2**63, 100, dtype=np.uint64)])
    whole = circulant.circulant(np.concatenate([a, b]), np.array([0, 1000]), 400, block=700)
    assert (whole[0] == circulant.circulant(a, np.array([0]), 400)[0]).all()
    assert abs((whole[0] == whole[1]).mean() - 900 / 1100) < 0.07
    assert len(np.unique(whole[0])) == 400
    keys = circulant.band_keys(whole[:, :12], 3)
    assert keys.shape == (2, 3) and len(np.unique(keys[0])) == 3


def test_sets_are_whole_texts(spark):
    column = pa.array([None, "a b c d e f", " ".join(BASE)])
    sizes = np.concatenate([n for *_, n, _ in circulant.sets_of(column, 5)])
    assert sizes.tolist() == [0, 2, len({tuple(BASE[i : i + 5]) for i in range(396)})]


def test_large_bucket_takes_as_many_pairs_as_members(spark):
    """Copies of one text with an edit each: the leader takes them all."""
    data = [(i, " ".join(f"edit{i}" if j == i else w for j, w in enumerate(BASE))) for i in range(1, 150)] + [(0, " ".join(BASE))]
    got = circulant.minhash_components(spark.createDataFrame(data, "doc_id long, text string"), numerator=85)
    assert rows(got.select("doc_id", "class_id").toPandas()) == rows(got.selectExpr("doc_id", "0L as class_id").toPandas())

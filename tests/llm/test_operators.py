"""The training-data operators on a small table of odd rows, against brute force, round trips and held-out labels."""

import re
import time
import zlib

import numpy as np
import pytest
from compare import rows
from pyspark.sql import functions as F

from hillframe.llm import chains, html_text, langid, mixing, ngram_join, packing, quality, registry, topk, toxicity, warc
from hillframe.llm.common import new_path

LOREM = " ".join(f"w{i * 7919 % 997}" for i in range(300))
PASSAGE = " ".join(f"shared{i}" for i in range(70))
TEXTS = [
    None, "", "   \n ", "one", "one", LOREM, LOREM, LOREM.replace("w5 ", "x5 ", 1), "Short text here.", LOREM.upper(),
    f"alpha beta gamma {PASSAGE} delta", " ".join(f"q{i}" for i in range(90)) + " " + PASSAGE.replace("shared30 ", "edited ") + " end", "a b c d e f g h i j " * 12, "Ünï cödé text 🙂 ###", "x" * 5000,
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, shard int, spans string"


@pytest.fixture(scope="module")
def odd(spark):
    data = [(i, t, [None, "aa", "bb"][i % 3], [None, "s1", "s2", "s1"][i % 4], 0, 7, 1, "z") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*data, data[5]], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    assert rows(registry.QUERIES[name](spark, sf_dir).toPandas()) == rows(duck.execute(registry.ORACLES[name]).df())


def test_warc_round_trip(spark):
    html = ["<p>a</p>", None, "<p>a</p>", "b" * 9000, "", "ü", "<p>a</p>", "ü"]
    data = [(i, f"http://h/{i}\n x", t, 1) for i, t in enumerate(html)] + [(2, "http://h/2", "<p>a</p>", 1), (None, None, "ü", 1)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, key int")
    folders = [new_path(spark, "warc-test") for _ in range(2)]
    manifests = [warc.write_warc(pages, f, shard_bytes=4000, roll_bytes=300).orderBy("file").collect() for f in folders]
    assert [(m["file"], m["sha1"]) for m in manifests[0]] == [(m["file"], m["sha1"]) for m in manifests[1]]
    assert len(manifests[0]) > 1
    got = warc.read_warc(spark, folders[0]).collect()
    assert len(got) == len(data)
    assert {r["payload_digest"] for r in got} == {warc.base32_sha1((t or "").encode()) for _, _, t, _ in data}
    first = {r["payload_digest"]: (r["record_key"], bytes(r["payload"])) for r in got if r["record_type"] == "response"}
    assert first[warc.base32_sha1(b"")][0] == 1 and first[warc.base32_sha1("ü".encode())] == (5, "ü".encode())
    for r in got:
        if r["record_type"] == "revisit":
            assert r["refers_to"] == first[r["payload_digest"]][0] and r["payload_bytes"] == len(first[r["payload_digest"]][1])
    empty = warc.write_warc(pages.limit(0), new_path(spark, "warc-test"))
    assert empty.count() == 0


def test_warc_ranges_hold_every_key(spark):
    keyed = spark.range(2000).select(F.col("id").alias("key"), F.lit(100).cast("long").alias("size"))
    bounds = warc._ranges(keyed, 2000, bins=16)
    sizes = np.bincount(np.searchsorted(bounds, np.arange(2000), side="right")) * 100
    assert sizes.sum() == 200_000 and sizes.max() <= 2500
    assert warc._ranges(keyed.repartition(7), 2000, bins=16) == bounds


def test_quality_statistics_equal_brute_force(odd, none):
    got = {r["doc_id"]: r for r in quality.text_statistics(odd).collect()}
    for i, t in enumerate(TEXTS):
        w = words(t)
        grams = [tuple(w[j : j + 5]) for j in range(len(w) - 4)]
        inside = {p for j, g in enumerate(grams) if grams.count(g) > 1 for p in range(j, j + 5)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(inside))
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
    assert quality.text_statistics(none).count() == 0


def test_rules_find_a_threshold():
    rng = np.random.default_rng(1)
    x = rng.random((900, len(quality.FEATURES)))
    bad = (x[:, 1] > 0.8) & (x[:, 4] < 0.5)
    rules = quality.learn_rules(x, bad, np.arange(900) % 3, list(quality.FEATURES))
    hit = np.zeros(900, dtype=bool)
    for r in rules.rules:
        hit |= np.all([(x[:, list(quality.FEATURES).index(f)] >= t) if up else (x[:, list(quality.FEATURES).index(f)] <= t) for f, up, t in r.conditions], axis=0)
    assert (hit == bad).mean() > 0.97
    assert quality.learn_rules(x[:0], bad[:0], np.zeros(0), list(quality.FEATURES)).rules == ()


def test_code_lengths_are_those_of_the_frozen_tree():
    text = b"abracadabra abracadabra"
    counts = {}
    for n in (1, 2, 3):
        for i in range(len(text) - n + 1):
            key = int.from_bytes(text[i : i + n], "big")
            counts[n, key] = counts.get((n, key), 0) + 1
    trees = langid.build_trees([("l", n, k, c) for (n, k), c in counts.items()], 2)

    def cost(context, byte):
        if context is None:
            return 8.0
        own = {k & 255: c for (n, k), c in counts.items() if n == len(context) + 1 and k >> 8 == int.from_bytes(context, "big")}
        shorter = context[1:] if context else None
        if not own:
            return cost(shorter, byte)
        total, kinds = sum(own.values()), len(own)
        return -np.log2(own[byte] / (total + kinds)) if byte in own else -np.log2(kinds / (total + kinds)) + cost(shorter, byte)

    probe = b"cadaxbra"
    want = sum(cost(probe[max(0, i - 2) : i], probe[i]) for i in range(len(probe)))
    got = trees.code_lengths(np.frombuffer(probe + b"ab", np.uint8), np.array([0, len(probe), len(probe), len(probe) + 2]))
    assert abs(got[0, 0] - want) < 1e-3 and got[1, 0] == 0


def test_language_held_out(spark, sf_dir, odd, none):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = registry.QUERIES["op3_langid"](spark, sf_dir).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").where("held_out and n_chars > 100").toPandas()
    assert len(got) and (got["lang"] == got["lang_pred"]).mean() > 0.9
    assert {r["lang_pred"] for r in langid.predict(odd.where("text is null or trim(text) = ''"), None).collect()} == {"und"}
    assert langid.train_trees(none) is None and langid.predict(none, None).count() == 0
    trees = langid.train_trees(odd)
    kept = langid.keep_in_a_language(odd, trees)
    assert kept.columns == odd.columns and kept.where("text is null").count() == 0 and kept.where("doc_id = 5").count() == 2


def test_toxic_words_are_found(spark, none):
    rng = np.random.default_rng(2)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 8))) for _ in range(400)]
    texts, labels = [], []
    for i in range(400):
        w = [vocabulary[j] for j in rng.integers(0, 400, 80)]
        toxic = i % 4 == 0
        if toxic:
            w[int(rng.integers(0, 80))] = "wretchedly"
            w[int(rng.integers(0, 80))] = "vermin"
        texts.append(" ".join(w))
        labels.append(toxic)
    y = np.array(labels)
    model = toxicity.fit(texts[:300], y[:300], np.arange(300) % 8 // 4)
    got = np.array([model.score(*model.evidence(t)[:2]) >= 0.3 for t in texts[300:]])
    assert (got == y[300:]).mean() > 0.9
    assert 0 <= model.score(*model.evidence("")[:2]) <= 1
    assert toxicity.fit(texts, np.zeros(400, dtype=bool), np.arange(400) % 2) is None
    assert toxicity.score(none, model).count() == 0


def test_rare_toxic_texts_are_sampled_by_class(spark):
    rng = np.random.default_rng(9)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 8))) for _ in range(300)]
    data = []
    for i in range(3000):
        w = [vocabulary[j] for j in rng.integers(0, 300, 40)]
        if i % 25 == 0:
            w[int(rng.integers(0, 40))] = "wretchedly"
            w[int(rng.integers(0, 40))] = "vermin"
        data.append((i, " ".join(w), int(i % 25 == 0)))
    t = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    model = toxicity.train(t.select("doc_id", "text"), t.select("doc_id", "toxic"), sample=200)
    assert model is not None and b"vermin" in model.toxic
    got = np.array([model.score(*model.evidence(x)[:2]) >= 0.3 for _, x, _ in data])
    y = np.array([y for _, _, y in data]) > 0
    assert got[y].mean() > 0.9 and got[~y].mean() < 0.05


def test_html_main_text(spark):
    page = "<html><head><title>T</title></head><body><nav><a href=/>Home</a></nav><div class='cookie-notice'>We</div><article><h1>Big  &amp;\n x</h1><p>one<b>two</b><br>three<p>four<script>'</p>'</script><aside>side</aside></article><footer>f</footer></body></html>"
    assert html_text.main_text(page) == "Big & x onetwo three four"
    assert html_text.main_text(None) == "" and html_text.main_text("<p>a<") == "a<" and html_text.main_text("plain") == "plain"
    shared = "<div>Same on every page</div><div><p>{}</p></div>"
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<body>{shared.format(LOREM[i * 9 : i * 9 + 60])}</body>", "x") for i in range(30)] + [(99, None, None, "x")], "page_id long, url string, html string, nodes string")
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    assert got[99] == "" and len(got) == 31
    assert all(LOREM[i * 9 : i * 9 + 60].strip() in got[i] for i in range(30))
    assert html_text.extract(pages.limit(0)).count() == 0


def test_html_tree_alone_decides(spark):
    rng = np.random.default_rng(12)
    menu = [f"item{i}" for i in range(14)]
    data, story = [], {}
    for i in range(60):
        story[i] = " ".join(f"w{int(v)}" for v in rng.zipf(1.3, 120) % 5000)
        links = " ".join(f"<a href='/{j}'>{menu[j]}</a>" for j in rng.permutation(14)[:11])
        data.append((i, f"http://h{i % 2}/{i}", f"<body><div class='x1'><div class='x2'>{links}</div></div><div class='y1'><p>{story[i]}</p></div><div class='z1'>Copyright Example {rng.integers(2000, 2020)} all rights reserved</div></body>"))
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert got == story
    assert all(html_text.main_text(h) != story[i] for i, _, h in data)  # the names say nothing


def test_html_every_word_of_a_node_counts(spark):
    words = sorted((f"v{i}" for i in range(20_000)), key=lambda w: zlib.crc32(w.encode()))
    common, own = words[:12], words[12:]  # those of least hash come back on every page
    first = [" ".join(common + own[i * 60 : i * 60 + 60]) for i in range(20)]
    second = [" ".join(own[5000 + i * 60 : 5060 + i * 60]) for i in range(20)]
    data = [(i, f"http://h/{i}", f"<body><div class='x1'><p>{first[i]}</p></div><div class='y1'><p>{second[i]}</p></div></body>") for i in range(20)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()} == {i: f"{first[i]} {second[i]}" for i in range(20)}


def test_html_words_inside_an_article_stay():
    page = "<article><h2 id='side-effects'>Side effects</h2><p class='side-note-text'>Text <math><mi>x</mi></math> on <object>fallback</object> end.</p><div class='share-buttons'>Share</div><div class='ad'>Buy</div><div class='cookie-notice'>We</div></article>"
    assert html_text.main_text(page) == "Side effects Text x on fallback end."


def test_html_names_do_not_hide_the_article():
    body = "<header class='entry-header'><h1>Title</h1></header><p>The story.</p><div class='sidebar'>ad</div>"
    for around in ("content-sidebar-wrap", "has-sidebar", "site comments-open", "plain"):
        for tag in ("article", "main"):
            assert html_text.main_text(f"<div class='{around}'><{tag}>{body}</{tag}><div class='sidebar'>beside</div></div>") == "Title The story."
    wrapped = f"<div class='has-sidebar'><article>{body}</article><div class='related'><article>A card that is longer than the story is</article></div></div>"
    assert html_text.main_text(wrapped) == "Title The story."
    assert html_text.main_text(f"<article>{body}</article><div class='related'><article>A card that is longer than the story is</article></div>") == "Title The story."
    assert html_text.main_text("<div id='content-sidebar-wrap'><p>A story of some length.</p><div class='sidebar'>aside</div></div><div class='ad'>buy</div>") == "A story of some length."
    assert html_text.main_text("<div class='sidebar'>short</div><p>A story of some length.</p>") == "A story of some length."
    assert html_text.main_text("<aside class='x'><article>card</article></aside><p>story</p>") == "story"


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(300, 20)), 3)
    x[7] = x[8]
    data = [(i, [float(v) for v in x[i]]) for i in range(300)] + [(300, None), (301, [float("nan")] * 20), (302, []), (50, [float(v) for v in x[50]]), (303, [1.0, 2.0])]
    got = topk.top_k(spark.createDataFrame(data, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0, candidate_block=64, query_block=3).toPandas()
    ints = np.floor(256 * x.astype(np.float32).astype(np.float64)).astype(int)
    for q in range(0, 300, 50):
        s = ints @ ints[q]
        want = sorted((-s[i], i) for i in range(300) if i != q)[:5]
        own = got[got["query_id"] == q].sort_values("rank")
        assert list(zip(-own["score"], own["vec_id"], strict=True)) == want


def test_top_k_of_large_components_is_exact(spark):
    data = [(0, [4194305 / 256, 4194305 / 256]), (1, [4194305 / 256, 4194304.99609375 / 256]), (2, [4194305 / 256, 4194306 / 256]), (3, [1e300, 0.0]), (4, [-5.0, 3.0])]
    got = [(r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(spark.createDataFrame(data, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k=3).orderBy("rank").collect()]
    q = 4194305
    assert got == [(1, 2, q * q + q * 4194306), (2, 1, q * q + q * 4194304), (3, 4, q * (-1280) + q * 768)]


def test_warc_files_do_not_depend_on_partitions(spark):
    pages = spark.createDataFrame([(7, "http://h/", f"<p>{i}</p>") for i in range(6)], "page_id long, url string, html string")
    sums = [[r["sha1"] for r in warc.write_warc(pages.repartition(n), new_path(spark, "warc-test")).collect()] for n in (1, 6)]
    assert sums[0] == sums[1]


def _components(texts, k, num):
    sets = [None if not words(t) else {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} for t in texts for w in [words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))]]
    label = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= num * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    return label, [len(s or ()) for s in sets]


def test_jaccard_components_equal_brute_force(spark, odd, none):
    rng = np.random.default_rng(4)
    texts = list(TEXTS)
    for n in (6, 9, 14, 30, 60, 200):
        base = [f"z{n}_{i}" for i in range(n)]
        for _ in range(8):
            w = list(base)
            for _ in range(int(rng.integers(0, 4))):
                w[int(rng.integers(0, n))] = f"e{rng.integers(0, 9)}"
            texts.append(" ".join(w))
    t = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for k, num in ((4, 85), (2, 60)):
        got = {r["doc_id"]: (r["class_id"], r["n_shingles"]) for r in ngram_join.jaccard_components(t, k=k, numerator=num).collect()}
        label, size = _components(texts, k, num)
        assert got == {i: (label[i], size[i]) for i in range(len(texts))}
    assert ngram_join.jaccard_components(none).count() == 0
    kept = ngram_join.one_of_each(odd)
    assert kept.columns == odd.columns and [r["doc_id"] for r in kept.where("doc_id in (5, 6, 7)").collect()] == [5]


def test_packing_is_whole_and_tight(spark, odd, none):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.token_pieces(odd, path, 64, 2)
    got = packing.pack(pieces, 64).toPandas()
    coder = packing.coder(path)
    whole = {i: coder.tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t in enumerate(TEXTS)}
    for r in got.itertuples():
        own = whole[r.doc_id][r.start : r.start + r.length]
        assert len(own) == r.length and zlib.crc32(np.asarray(own, "<u4").tobytes()) == r.ids_crc32
    assert got["length"].sum() == sum(map(len, whole.values())) + len(whole[5])
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert (s["offset"].to_numpy() == np.concatenate([[0], np.cumsum(s["length"])[:-1]])).all() and s["length"].sum() <= 64
    assert packing.pack(packing.token_pieces(none, path, 64, 2), 64).count() == 0
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 1025, 5000)
    plan = packing.plan(dict(zip(*map(np.ndarray.tolist, np.unique(sizes, return_counts=True)), strict=True)), 1024)
    sequences = max(first + n for _, _, n, first, _, _ in plan)
    assert sequences <= 1.015 * sizes.sum() / 1024 + 1


def test_words_and_texts_tokenize_alike():
    import public_tokenizers

    coder = packing.coder(public_tokenizers.path("byte_bpe_50k.json"))
    for t in ["a.\nb", "It's 5.\nx", "x, y,", "don't.\n'q' .", "a\n\nb c", "1.\n2, 3.", " lead", "trail ", "ü.\nß,", "a_. b_,", "x'. y", "\n", ". , .", "3.5, 7.\n", "<|endoftext|> x", "x" * 30000, "\n" * 5000, *filter(None, TEXTS)]:
        assert np.frombuffer(coder.encode(t), "<u4").tolist() == coder.tokenizer.encode(t, add_special_tokens=False).ids
    assert coder.ranked is not None
    rng = np.random.default_rng(11)
    letters = np.array([*"abcXYZ019 .,'\n\t-_", "'s", "  ", "ß", "é", "中", "🙂", "\u2028", "\u00a0", "١", "Ⅷ", "\x00", "e\u0301"])
    texts = ["".join(rng.choice(letters, int(rng.integers(1, 60)))) for _ in range(5000)]
    assert [np.frombuffer(coder.encode(t), "<u4").tolist() for t in texts] == [e.ids for e in coder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    other = packing.coder(public_tokenizers.path("word_bpe_49k.json"))
    assert other.ranked is None and np.frombuffer(other.encode("Some text"), "<u4").tolist() == other.tokenizer.encode("Some text", add_special_tokens=False).ids


def test_mixing(spark, sf_dir, odd, none):
    a, b = (registry.QUERIES["op9_mixing"](spark, sf_dir).orderBy("doc_id").toPandas() for _ in range(2))
    assert a.equals(b)
    assert (a["taken"] <= 3 * a["size"]).all()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source").toPandas()
    per = a.merge(docs, on="doc_id").groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("source_size", "first"))
    assert (abs(per["taken"] - per["target"]) <= 4 * 32).all() and (per["target"] <= 3 * per["size"] + 1e-6).all()
    votes = [5.0, 3.0, 1.0, 0.2]
    seats = [0] * 4
    for _ in range(11):
        i = max(range(4), key=lambda i: (votes[i] / (2 * seats[i] + 1), -i))
        seats[i] += 1
    assert mixing.sainte_lague(votes, 11) == seats
    assert mixing.mix_sources(odd).count() == odd.count() and mixing.mix_sources(none).count() == 0
    assert mixing.mixed_documents(odd).columns == odd.columns


def test_chains_find_the_fuzzy_passage(spark, odd, none):
    spans, copies = chains.repeated_passages(odd)
    found = chains.passages(spans, copies).toPandas()
    fuzzy = found[found["doc_id"] == 11].iloc[0]
    assert (fuzzy["from_word"], fuzzy["to_word"], fuzzy["source_id"]) == (90, 160, 10)
    assert not set(found["doc_id"]) & {0, 1, 2, 3, 4, 8, 12, 13, 14}
    left = chains.remove_passages(odd, chains.passages(spans, copies, both_sides=False))
    got = {r["doc_id"]: r["text"] for r in left.collect()}
    assert left.columns == odd.columns and 6 not in got and "shared5" not in got[11] and got[11].split()[-1] == "end" and got[10] == TEXTS[10]
    spans, copies = chains.repeated_passages(none)
    assert chains.passages(spans, copies).count() == 0


def test_chain_equals_quadratic_search():
    rng = np.random.default_rng(6)
    for _ in range(30):
        runs = sorted((int(x), int(y), int(n)) for x, y, n in zip(rng.integers(0, 60, 9), rng.integers(0, 60, 9), rng.integers(3, 9, 9), strict=True))
        best = []
        for i, (x, y, n) in enumerate(runs):
            gains = [best[j] - 0.5 * (x - a - m + y - b - m) for j, (a, b, m) in enumerate(runs[:i]) if a + m <= x and b + m <= y]
            best.append(n + max([0.0, *gains]))
        top = chains.chain(runs, 0.5, 1000)[0]
        score = sum(r[2] for r in top) - 0.5 * sum(q[0] - p[0] - p[2] + q[1] - p[1] - p[2] for p, q in zip(top, top[1:], strict=False))
        assert abs(score - max(best)) < 1e-9


def test_chain_equals_quadratic_search_within_reach():
    rng = np.random.default_rng(7)
    for most_gap, wide in ((60, 400), (60, 1200), (5, 60)):
        for _ in range(60):
            runs = sorted((int(x), int(y), int(n)) for x, y, n in zip(rng.integers(0, wide, 40), rng.integers(0, wide, 40), rng.integers(5, wide // 6, 40), strict=True))
            best = []
            for i, (x, y, n) in enumerate(runs):
                gains = [best[j] - 0.5 * (x - a - m + y - b - m) for j, (a, b, m) in enumerate(runs[:i]) if 0 <= x - a - m <= most_gap and 0 <= y - b - m <= most_gap]
                best.append(n + max([0.0, *gains]))
            top = chains.chain(runs, 0.5, most_gap)[0]
            assert all(q[0] - p[0] - p[2] <= most_gap and q[1] - p[1] - p[2] <= most_gap for p, q in zip(top, top[1:], strict=False))
            score = sum(r[2] for r in top) - 0.5 * sum(q[0] - p[0] - p[2] + q[1] - p[1] - p[2] for p, q in zip(top, top[1:], strict=False))
            assert abs(score - max(best)) < 1e-9
    runs = [(0, 0, 500), (570, 570, 30), (606, 600, 30)]
    assert chains.chain(runs) == [[(0, 0, 500)], [(570, 570, 30), (606, 600, 30)]]


def test_chains_find_passages_edited_every_six_words(spark):
    rng = np.random.default_rng(8)
    texts = []
    for n in range(60):
        own = [f"p{n}_{i}" for i in range(60)]
        edited = [f"e{n}_{i}" if i % (6 + n % 3) == 5 else w for i, w in enumerate(own)]
        for side, middle in enumerate((own, edited)):
            around = [f"u{n}_{side}_{i}" for i in range(int(rng.integers(20, 60)))]
            texts.append(" ".join([*around[:20], *middle, *around[20:]]))
    spans, copies = chains.repeated_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), share_seeds=1000)
    found = {r["doc_id"]: r["source_id"] for r in chains.passages(spans, copies, both_sides=False).collect()}
    assert found == {i: i - 1 for i in range(1, 120, 2)}


def test_a_passage_whose_parts_others_hold_is_found(spark):
    shared = [f"s{i}" for i in range(60)]
    texts = [" ".join([*(f"a{n}_{i}" for i in range(30)), *shared[9 * n : 9 * n + 11], *(f"b{n}_{i}" for i in range(30))]) for n in range(7)]
    texts += [" ".join([*(f"c{n}_{i}" for i in range(40)), *shared, *(f"d{n}_{i}" for i in range(40))]) for n in range(2)]
    spans, copies = chains.repeated_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    found = {(r["doc_id"], r["from_word"], r["to_word"]) for r in chains.passages(spans, copies).collect()}
    assert found == {(7, 40, 100), (8, 40, 100)}


def test_short_and_long_seeds_of_one_key_have_lists_of_their_own(spark):
    def led(*seeds):
        data = []
        for doc, place, salt in seeds:
            parts = [np.array([v], kind) for v, kind in ((77, np.uint64), (doc, np.int64), (1, np.uint32), (place, np.int32), (salt, np.int32))]
            key, *rest = (bytearray(chains.planes(v)) for v in parts)
            data.append((0, key[: chains.KEY_BYTES], *rest))
        return chains.led_places(spark.createDataFrame(data, chains.SEEDS), 1, 7).collect()

    plain = lambda found: sorted((r["doc"], r["pos"], r["lead"], r["lead_pos"]) for r in found)
    # a place is twice the word's, and one more for a seed of 12 words: a text of 163 words may have a short one at 155, but no long one
    assert led((1, 2 * 155, 0), (2, 2 * 143 + 1, 0)) == []
    found = led((1, 2 * 155, 0), (2, 2 * 143 + 1, 0), (3, 2 * 9 + 1, 0), (4, 2 * 5, 0))
    assert plain(found) == [(3, 9, 2, 143), (3, 16, 2, 150), (4, 5, 1, 155)]
    found = led((1, 2 * 155, 1), (2, 2 * 143 + 1, 1))
    assert plain(found) == [(1, 155, 1, 155), (2, 143, 2, 143), (2, 150, 2, 150)]
    assert len({r["key"] for r in found}) == 3


def test_passages_are_found_where_seeds_agree_by_chance(spark, monkeypatch):
    monkeypatch.setattr(chains, "KEY_BYTES", 2)  # as often as five bytes do in many more texts
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10**9, 40)) for _ in range(200)]
    shared = " ".join(f"s{i}" for i in range(60))
    texts[30], texts[150] = f"{texts[30]} {shared}", f"{shared} {texts[150]}"
    spans, copies = chains.repeated_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    found = {(r["doc_id"], r["from_word"], r["to_word"], r["source_id"], r["is_source"]) for r in chains.passages(spans, copies).collect()}
    assert found == {(30, 40, 100, 30, True), (150, 0, 60, 30, False)}


STAGE_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, spans string, pieces string, own_id long, span_doc long, keep_0 int, sig long, grp int"


def test_pipeline_stages_on_odd_tables(spark, sf_dir):
    import corpus_pipeline

    data = [(i, t, [None, "aa", "bb"][i % 3], [None, "s1", "s.2"][i % 3], 0, "x", "y", None, 7, 7, 1, 2, 3) for i, t in enumerate(TEXTS)]
    long = " ".join(f"v{i * 7907 % 99991}" for i in range(60_000))
    data += [data[5], (None, LOREM, "aa", None, 0, *data[0][5:]), (None, None, None, None, None, *[None] * 8), (90, long, "bb", "s1", 0, *data[0][5:])]
    odd = spark.createDataFrame(data, STAGE_COLUMNS)
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:4]:
            docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), STAGE_COLUMNS)
            assert docs.columns == odd.columns, name
        packed = corpus_pipeline.pack(spark, docs, sf_dir)
        assert packed.select("doc_id", "length", "sequence_id", "offset").where("length > 1024").count() == 0
        docs = packed
    kept = corpus_pipeline.near_duplicates(spark, odd, sf_dir).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [0, 1, 2, 3, 5, 8, 10, 11, 12, 13, 14, 90] and sum(r["doc_id"] is None for r in kept) == 2
    mixed = corpus_pipeline.mix(spark, odd, sf_dir).toPandas()
    by_doc = mixing.mix_sources(odd).toPandas()
    assert by_doc["taken"].sum() == sum(len(words(t)) for t in mixed["text"])


def test_pipeline_keeps_clean_documents(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    step = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        step = stage(spark, step, sf_dir)
        assert step.columns == docs.columns, name
    assert 0.5 * docs.count() < step.count() <= docs.count()
    packed = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert (packed.groupby("sequence_id")["length"].sum() <= 1024).all()


def test_html_comments_go_and_deep_pages_are_read_in_time(spark):
    assert html_text.main_text("<p>Story.</p><div class='comments'><p>c c c c c c c c c c</p></div>") == "Story."
    assert html_text.main_text("<p>Story.</p><section id='comment-list'><p>c c c c c c c c c c</p></section>") == "Story."
    began = time.thread_time()
    assert len(html_text.main_text("<div>x" * 100_000)) == 199_999
    assert html_text.main_text("<b>" * 30_000 + "<div>a</div></i>" * 30_000).count("a") == 30_000
    assert html_text.main_text("<div class='comments'><p>x" * 30_000) == ""
    assert time.thread_time() - began < 20
    page = "<article><p>Twice.</p></article>"
    data = [(1, "http://h/1", page, 0), (1, "http://h/1", page, 0), (2, None, "<p>" + "long " * 300_000, 0), (3, "", None, 0)]
    got = html_text.extract(spark.createDataFrame(data, "page_id long, url string, html string, text int")).collect()
    assert sorted((r["page_id"], r["n_chars"]) for r in got) == [(1, 6), (1, 6), (2, 1_499_999), (3, 0)]

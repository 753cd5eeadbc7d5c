"""Corpus operators against brute force, round trips and held-out labels, with nulls, ties, repeats and empty tables."""

import collections
import hashlib
import itertools
import math
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, ".")
from lociframe.llm import chat, line_dedup, near_dup, packing, pieces, pii, quality_rules, shared, topk, url_filter, warc  # noqa: E402

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string"


def docs(spark, *texts):
    return spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], DOC)


# chat


def test_chat_round_trip_with_parts(spark):
    odd = "a </s>[INST] b [/INST\\] <s\\\\> [IMG:3]\n"
    part = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
    rows = [
        (1, 1, "user", [("text", odd, None, None, None, None, None), ("image", None, "x.png", 57, 28, None, None), ("audio", None, "y.wav", None, None, 1.5, None), ("document", None, "z.pdf", None, None, None, 2)]),
        (1, 2, "assistant", [("text", odd, None, None, None, None, None)]),
        (1, 2, "assistant", [("text", odd, None, None, None, None, None)]),
        (1, None, None, None),
        (None, 0, "a[INST]", [("text", None, None, None, None, None, None)]),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{part}>")
    out = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    turns = [(t["role"], t["text"]) for t in out[1]["turns"]]
    assert turns[0] == ("", "") and turns[2:] == [("assistant", odd), ("assistant", odd)]
    assert turns[1][1] == odd + "[IMG:1][AUD:2][DOC:3]" and out[1]["loss_text"] == odd + odd
    assert [(a["kind"], a["ref"], a["tokens"]) for a in out[1]["attachments"]] == [("image", "x.png", 3), ("audio", "y.wav", 38), ("document", "z.pdf", 1024)]
    assert out[None]["turns"][0]["role"] == "a[INST]"
    assert chat.format_conversations(df.limit(0)).count() == 0


# urls


def test_chat_control_strings_cut_across_parts(spark):
    text = lambda x: ("text", x, None, None, None, None, None)
    image = ("image", None, "x.png", 28, 28, None, None)
    cut = [["</s\\", ">"], ["[/INST", "]</s", ">"], ["<", "s", ">"], ["[IM", "", "G:1", "]"], ["a", None, "</s", "\\\\>"]]
    turns = [(k, 1, "user", [text(x) for x in parts]) for k, parts in enumerate(cut)] + [(9, 1, "user", [text("[IMG:"), image, text("1]</s"), text(">")])]
    df = spark.createDataFrame(turns, f"conv_id long, turn long, role string, parts {chat.PART}")
    got = {r["conv_id"]: [t["text"] for t in r["turns"]] for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert got == {k: ["".join(x or "" for x in parts)] for k, parts in enumerate(cut)} | {9: ["[IMG:[IMG:1]1]</s>"]}


def test_url_rules_and_mining(spark):
    url = lambda u: spark.createDataFrame([(u,)], "u string").select(*[x.alias(n) for x, n in zip(url_filter.url_parts(F.col("u")), "hp", strict=True)]).first()[:]
    assert url("HTTP://WWW.Éx.COM/a/B?q#f") == ("www.Éx.com", "/a/B") and url("x") == ("", "") and url(None) == ("", "") and url("a://h#x://y/") == ("h", "")
    urls = [f"http://{h}.site{i % 5}.org/{p}/{i}" for i in range(200) for h, p in (("ads", "win"), ("ads", "news"), ("www", "win"))]
    pages = spark.createDataFrame([*enumerate(urls), (9001, None), (9002, "none"), (9003, "https://www.example.com/en/x"), (9004, "https://a.example.com/en/x"), (9005, "http://q.net/es/")], "page_id long, url string")
    labels = spark.createDataFrame([(i, 1, 1 if "//ads" in u and "/win/" in u else 0) for i, u in enumerate(urls)] + [(77777, 0, None), (9001, None, None)], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: r for r in url_filter.judge(pages, labels, min_confidence=0.6).collect()}
    assert len(got) == len(urls) + 5
    for i, u in enumerate(urls):  # brute force: the only combination over half bad
        assert (got[i]["verdict"] == "block") == ("//ads" in u and "/win/" in u)
    assert got[9001]["verdict"] == "allow" and got[9003]["rule"] == "www.example.com/en/" and got[9004]["verdict"] == "block" and got[9005]["rule"] == "net/es/"
    assert {r["verdict"] for r in url_filter.judge(pages, labels.limit(0), rules=()).collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), labels).count() == 0


def brute_rules(rows, least, confidence):
    """All minimal sets of tokens with enough blocked rows and confidence."""
    n, found = len(rows), {}
    names = sorted({t for items, _ in rows for t in items})
    for size in range(1, 5):
        for chosen in itertools.combinations(names, size):
            hit = [bad for items, bad in rows if set(chosen) <= set(items)]
            if sum(hit) >= least and sum(hit) >= confidence * len(hit) and not any(set(k) < set(chosen) for k in found):
                found[chosen] = (sum(hit) / len(hit), sum(hit) / n)
    return found


@pytest.mark.parametrize("seed", range(3))
def test_url_rules_against_a_brute_miner(spark, seed):
    rng = random.Random(seed)
    names = [f"t{i}" for i in range(7)]
    rows = []
    for _ in range(60):
        items = [t for t in names if rng.random() < 0.45]
        items += ["twin"] if "t0" in items else []
        bad = len({"t1", "t2"} & set(items)) == 2 or "t3" in items and rng.random() < 0.6 or rng.random() < 0.15
        rows.append((items, bad))
    df = spark.createDataFrame([r for r in rows if r[0]], "items array<string>, blocked boolean")
    rules, classes = url_filter.mine(df, 0.05, 0.6, 3)
    members = {}
    for r in classes.collect():
        members.setdefault(r["item"], []).append(r["token"])
    n = sum(1 for r in rows if r[0])
    got = {}
    for r in rules.collect():
        for chosen in itertools.product(*(members[t] for t in r["antecedent"])):
            got[tuple(sorted(chosen))] = (round(r["confidence"], 9), round(r["support"], 9))
    expected = brute_rules([r for r in rows if r[0]], max(3, math.ceil(0.05 * n)), 0.6)
    assert {k for k in got if len(k) < 5} == set(expected) and expected
    assert got == {k: (round(c, 9), round(s, 9)) for k, (c, s) in expected.items()} | {k: v for k, v in got.items() if len(k) > 4}


def test_repeated_long_urls_end(spark):
    """Labelled rows that share one url with 60 names, and others with parts of it; repeated ids and clashing columns."""
    name = lambda ks: "http://a.b.c/x?" + "&".join(f"n{k}=1" for k in ks)
    urls = [name(range(60))] * 6 + [name(range(0, 60, 2))] * 6 + [f"http://ok{i}.org/y" for i in range(20)] + ["http://new.com/?n7=2", "http://new.com/?n8=2&n9=3"]
    pages = spark.createDataFrame([(i, u, True, "clash") for i, u in enumerate(urls)] + [(0, "http://other.org/", None, None)], "page_id long, url string, mined boolean, items string")
    labels = spark.createDataFrame([(i, 1, int(i < 6)) for i in range(32)], "doc_id long, quality int, toxic int")
    got = url_filter.judge(pages, labels, rules=(), min_confidence=0.6).collect()
    # odd names are in bad urls alone; even ones are in as many good ones
    assert sorted(r["page_id"] for r in got if r["verdict"] == "block") == [*range(6), 32, 33] and len(got) == 35


# packing


def test_packing(spark):
    from tokenizers import Tokenizer

    texts = ["Hello, world. don't X,, y,. <|endoftext|>", "", None, "word " * 5000, "\x1c a\tb\n\nÉté. 12,5.", "same text", "same text"]
    t = Tokenizer.from_file(WORDS)
    want = {i: t.encode(x or "", add_special_tokens=False).ids + [1] for i, x in enumerate(texts)}
    pieces_ = packing.tokenize_pieces(docs(spark, *texts), WORDS, with_ids=True)
    got = collections.defaultdict(list)
    for r in sorted(pieces_.collect(), key=lambda r: (r["doc_id"], r["start"])):
        assert r["start"] == len(got[r["doc_id"]])
        got[r["doc_id"]] += r["ids"]
    assert got == want
    plan = packing.pack(pieces_).collect()
    by = collections.defaultdict(list)
    for r in plan:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for x in by.values():
        x.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(x, x[1:], strict=False)) and x[0][0] == 0 and sum(x[-1]) <= 2048
    wide = packing.pack(pieces_.withColumn("extra", F.lit("x")).withColumn("offset", F.lit(7)), partitions=3).collect()
    assert len(wide) == len(plan) and set(wide[0].asDict()) == set(plan[0].asDict())
    whole = packing.sequences(pieces_, packing.pack(pieces_)).agg(F.sum(F.size("ids"))).first()[0]
    assert whole >= sum(map(len, want.values()))
    assert packing.pack(packing.tokenize_pieces(docs(spark, "a").limit(0), WORDS)).count() == 0


def test_best_fit_against_plain_search():
    rng = random.Random(3)
    lengths = sorted((rng.randint(1, 64) for _ in range(400)), reverse=True)
    seq, off = packing.best_fit(np.array(lengths), 64)
    rooms: list[int] = []
    for n, s, o in zip(lengths, seq, off, strict=True):
        fits = [r for r in rooms if r >= n]
        assert (64 - o) == (min(fits) if fits else 64)
        if s == len(rooms):
            rooms.append(64)
        rooms[s] -= n


# top-k


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(400, 6)).round(1)
    rows = [(i, v[i % 300].tolist()) for i in range(400)] + [(900, None), (901, [1.0, None]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (904, []), (905, [2.0]), (None, [1.0])]
    w = topk.whole_numbers(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(w.where("vec_id % 100 = 0"), w, 10, block_rows=64, query_rows=2).collect()}
    whole = {r["vec_id"]: r["v"] for r in w.collect()}
    assert set(whole) == {*range(400), 904, 905}
    for q in (0, 100, 200, 300):
        best = sorted((-sum(a * b for a, b in zip(whole[q], whole[c], strict=False)), c) for c in whole if c != q)[:10]
        assert [got[q, k + 1] for k in range(10)] == [(c, -s) for s, c in best]
    assert topk.top_k(w.limit(0), w).count() == 0


# sampled pieces


def test_pieces_are_lossless_and_follow_the_lattice(spark):
    texts = ["Hello world", "", None, "  two  spaces \n\n ▁ <0x0A> 😀 été", "a" * 9000 + " é", "Hello world"]
    both = pieces.decode(pieces.encode(docs(spark, *texts), PIECES).join(docs(spark, *texts).select("doc_id", "text"), "doc_id"), PIECES)
    got = {r["doc_id"]: r for r in both.collect()}
    assert [got[i]["decoded"] for i in range(6)] == texts and got[2]["ids"] is None
    again = {r["doc_id"]: r["ids"] for r in pieces.encode(docs(spark, *texts).repartition(3), PIECES).collect()}
    assert again == {i: r["ids"] for i, r in got.items()}
    lat = pieces.Lattices(PIECES, 1e-5)
    ids, n = lat.encode(["cat"] * 8000, list(range(8000)))
    at = np.concatenate([[0], np.cumsum(n)])
    seen = collections.Counter(tuple(ids[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True))

    def paths(u):
        if not u:
            yield ()
        for j in range(1, len(u) + 1):
            if u[:j] in lat.pieces:
                yield from ((lat.pieces[u[:j]], *p) for p in paths(u[j:]))

    weight = {p: math.exp(1e-5 * sum(lat.scores[list(p)])) for p in paths(b" cat")}
    for p, x in weight.items():
        assert abs(seen[p] / 8000 - x / sum(weight.values())) < 0.025


def test_long_units_are_sampled_whole(monkeypatch):
    lat = pieces.Lattices(PIECES, 1e-5)
    assert not lat.whole
    plain = lat.encode(["antidisestablishmentarianism"] * 3000, list(range(3000)))
    monkeypatch.setattr(pieces, "UNIT_BYTES", 8)
    for window in (3, 7, 1 << 16):
        monkeypatch.setattr(pieces, "WALK_BYTES", window)
        walked = pieces.Lattices(PIECES, 1e-5).encode(["antidisestablishmentarianism"] * 3000, list(range(3000)))
        assert (walked[1] == plain[1]).mean() > 0.999 and len(walked[0]) - len(plain[0]) < 10  # the same draws, but for rounding
    monkeypatch.setattr(pieces, "UNIT_BYTES", 4096)
    text = "".join(random.Random(3).choice(["cat", "é", "😀", "\t", "xyz"]) for _ in range(6000))
    ids, n = pieces.Lattices(PIECES, 1e-5).encode([f"a {text} b", "x"], [5, 6])
    assert lat.decode(ids[: n[0]].tolist()) == f"a {text} b" and lat.decode(ids[n[0] :].tolist()) == "x"


# near-duplicates


def _classes(texts, n, rare=near_dup.RARE):
    def sh(t):
        w = (t or "").encode().split()
        return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()

    sets = [sh(t) for t in texts]
    df = collections.Counter(k for s in sets for k in s)
    w = [{k: c * (1 + rare * math.log(n / df[k]) / math.log(n)) for k, c in s.items()} for s in sets]
    label = list(range(len(texts)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            common = sum(min(v, w[j][k]) for k, v in w[i].items() if k in w[j])
            if common and common / (sum(w[i].values()) + sum(w[j].values()) - common) >= 0.8:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("split", [128, 2])
def test_near_dup_against_all_pairs(spark, monkeypatch, split):
    monkeypatch.setattr(near_dup, "SPLIT", split)
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base = [[word() for _ in range(rng.randint(5, 120))] for _ in range(60)]
    hot = [word() for _ in range(80)]
    texts = [" ".join(b) for b in base]
    for _ in range(150):
        b = list(rng.choice([*base[:20], hot]))
        for _ in range(rng.randint(0, 4)):
            b[rng.randrange(len(b))] = rng.choice([word(), "aaaa", "bbbb"])
        texts.append(" ".join(b))
    texts += [texts[3]] * 20 + ["", None, " \n", "one two", "one two", "x"]
    got = {r["doc_id"]: r["class_id"] for r in near_dup.classes(docs(spark, *texts).repartition(3)).collect()}
    assert [got[i] for i in range(len(texts))] == _classes(texts, len(texts))
    kept = near_dup.keep_one(docs(spark, *texts), spark.createDataFrame(list(got.items()), "doc_id long, class_id long"))
    assert kept.columns == ["doc_id", "text", "lang"] and kept.count() == len(set(got.values()))


def test_near_dup_recall_on_long_texts(spark):
    rng = random.Random(5)
    texts = []
    for k in range(24):
        a = ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(20_000)]
        b = list(a)
        for i in rng.sample(range(0, 20_000, 5), 330 + 4 * k):  # 0.80 to 0.85 alike
            b[i] = "x" + b[i]
        texts += [" ".join(a), " ".join(b)]
    texts += ["z"] * 3  # so that idf is near 1
    got = {r["doc_id"]: r["class_id"] for r in near_dup.classes(docs(spark, *texts)).collect()}
    want = _classes(texts, len(texts))
    near = [i for i in range(0, 48, 2) if want[i + 1] == i]
    assert len(near) >= 20 and sum(got[i + 1] == i for i in near) >= 0.9 * len(near) and all(got[i] == i for i in range(0, 48, 2))


def test_near_dup_empty_and_null_ids(spark):
    assert near_dup.classes(docs(spark, "a").limit(0)).count() == 0
    df = spark.createDataFrame([(None, "a b c d e f", "x"), (1, "a b c d e f", "x"), (1, "a b c d e f", "x")], DOC)
    assert [tuple(r) for r in near_dup.classes(df).collect()] == [(1, 1)]
    assert near_dup.keep_one(df, near_dup.classes(df)).count() == 2


def test_near_dup_different_texts_under_one_id(spark):
    near = "the quick brown fox jumps over the lazy dog and runs away into the deep dark wood beyond the old stone bridge by the mill " * 2
    rows = [(1, "a b c d e f g h", "p"), (1, "completely different text of some length here", "q"), (1, "a b c d e f g h", "r"), (1, None, "s"), (2, "a b c d e f g h", "t")]
    rows += [(3, near + "x y", "u"), (3, near, "v"), (4, near, "w"), (5, "only one", "x"), (None, near, "y"), (None, None, "z")]
    df = spark.createDataFrame(rows, DOC).repartition(4)
    found = near_dup.classes(df)
    assert sorted((r["doc_id"], r["class_id"]) for r in found.collect()) == [(1, 1), (1, 1), (1, 1), (2, 1), (3, 3), (3, 3), (4, 3), (5, 5)]
    kept = near_dup.keep_one(df, found)
    assert kept.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert [g for g in got if g[0] in (1, 2)] == sorted([(1, "a b c d e f g h"), (1, "completely different text of some length here"), (1, None)], key=str)
    assert len([g for g in got if g[0] in (3, 4)]) == 1 and (5, "only one") in got and len([g for g in got if g[0] is None]) == 2


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_texts_without_words_are_classes_of_their_own(spark, parts):
    texts = [None, None, "", "", " ", " ", " \n", " \n", "x", "x"] * 3
    df = docs(spark, *texts).repartition(parts)
    got = {r["doc_id"]: r["class_id"] for r in near_dup.classes(df).collect()}
    assert [got[i] for i in range(len(texts))] == [8 if t == "x" else i for i, t in enumerate(texts)]
    assert near_dup.keep_one(df, near_dup.classes(df)).count() == len(texts) - 5


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200), (200, 100), (7, 7)], "a long, b long")
    got = {r["id"]: r["label"] for r in shared.components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100}


# warc


def test_warc_round_trip(spark):
    big = "é" * 700
    df = spark.createDataFrame([(1, "http://a/\r\nx", big, 5), (2, None, big, 5), (3, "u", "small", 5), (4, "u", "small", 5), (5, "u", None, 5), (None, "v", big, 5), (6, "u", "z" * 300_000, 5)], "page_id long, url string, html string, revisit int")
    folder = f"{shared.shared_folder(spark)}/warc-test-{random.random()}"
    index = shared.cut(warc.write(warc.dedup_plan(df), folder, frame_bytes=1000, bundle_bytes=2000))
    got = sorted(((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.read(folder, index).collect()), key=str)
    sizes = {1: 1400, 2: 1400, 3: 5, 4: 5, 5: 0, 6: 300_000, 0: 1400}
    assert got == sorted(((i, n, "revisit" if i in (0, 1) else "response", 2 if i in (0, 1) else None) for i, n in sizes.items()), key=str)
    one = warc.fetch(index, folder, spark.createDataFrame([("<urn:page:2>",)], "record_id string")).collect()
    head, block, _ = warc.parse(one[0]["record"])
    assert block.decode() == big and head["WARC-Payload-Digest"] == "sha1:" + hashlib.sha1(big.encode()).hexdigest()
    empty = shared.cut(warc.write(warc.dedup_plan(df.limit(0)), folder + "e"))
    assert warc.read(folder + "e", empty).count() == 0


# lines


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_distance():
    rng = random.Random(1)
    for _ in range(3000):
        a, b = ("".join(rng.choice("abé") for _ in range(rng.randint(0, 12))) for _ in "ab")
        for most in (0, 1, 2, 3):
            assert line_dedup.edit_distance(a, b, most) == min(_distance(a, b), most + 1)


@pytest.mark.parametrize(("hot", "depth"), [(32, 3), (2, 3), (1, 2), (32, 0)])
def test_line_join_against_all_pairs(spark, monkeypatch, hot, depth):
    monkeypatch.setattr(line_dedup, "HOT_LINES", hot)
    monkeypatch.setattr(line_dedup, "DEPTH", depth)
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (5, 12, 19, 20, 21, 25, 33, 39, 40, 41, 42, 48, 55, 60, 300, 5000)]
    base += ["a" * 45, "ab" * 15, "x y" * 20]
    lines = []
    for _ in range(250):
        x = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(x))
            x[i : i + 1] = rng.choice(["", "z", x[i] + "y"])
        lines.append("".join(x))
    lines += ["short", "short", "shorts", "", "  "]
    texts = ["\n".join(lines[i : i + 7]) for i in range(0, len(lines), 7)] + [None, ""]
    got = {(r["doc_id"], r["line_no"]): r for r in line_dedup.judge(docs(spark, *texts)).collect()}
    own = {(d, k): x for d, t in enumerate(texts) if t for k, x in enumerate(t.split("\n")) if x.strip()}
    assert set(got) == set(own)
    distinct = sorted(set(own.values()))
    near = set()
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            most = min(2, min(len(a), len(b)) // 20)
            if most and abs(len(a) - len(b)) <= most and (_distance(a, b) if len(a) < 100 else line_dedup.edit_distance(a, b, most)) <= most:
                near |= {(a, b), (b, a)}
    assert len({min(len(a), len(b)) for a, b in near}) > 10
    label = {x: x for x in distinct}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in near:
        label[root(a)] = root(b)
    first = {}
    for at in sorted(own):
        first.setdefault(root(own[at]), at)
    for at, x in own.items():
        r = got[at]
        assert (r["class_doc"], r["class_line"]) == first[root(x)] and r["n_links"] == sum(a == x for a, _ in near) and r["kept"] == (at == first[root(x)])
    if (hot, depth) == (32, 3):
        clean = line_dedup.clean(docs(spark, *texts), line_dedup.judge(docs(spark, *texts)))
        assert clean.columns == ["doc_id", "text", "lang"] and sum(len([y for y in (r["text"] or "").split("\n") if y.strip()]) for r in clean.collect()) == len(first)
        assert line_dedup.judge(docs(spark, "a").limit(0)).count() == 0


def test_clean_with_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a\nb", 1, "x", 5), (1, "a\nb", 1, "x", 5), (2, "b\nc", None, None, 6), (None, "b", 3, "z", 7)], "doc_id long, text string, gone int, id string, `row.x` int")
    out = line_dedup.clean(df, line_dedup.judge(df))
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, "a\nb", 1, "x", 5), (1, "a\nb", 1, "x", 5), (2, "c", None, None, 6), (None, "b", 3, "z", 7)], key=str)


def test_clean_of_different_texts_under_one_id(spark):
    rows = [(1, "seen\nown line", "en"), (2, "other\nseen", "en"), (2, "first\nfound nowhere else", "en"), (3, "seen", "en"), (3, None, "en"), (3, " ", "en")]
    df = spark.createDataFrame(rows, DOC)
    got = [r["text"] for r in line_dedup.clean(df, line_dedup.judge(df)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, ["seen\nown line", "other", "first\nfound nowhere else", None, " "]))


# quality


def test_base_counts_against_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        t = "".join(rng.choice(["a ", "b ", "é\u00a0", "#|", "\n", "\t", "c\x0b"]) for _ in range(rng.randint(0, 60)))
        words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", t) if w]
        grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        many = collections.Counter(grams)
        repeat = {j for i, g in enumerate(grams) if many[g] > 1 for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if any(c not in " \t\n\x0b\x0c\r" for c in x)]
        assert quality_rules.base_counts(t) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeat))
    assert quality_rules.base_counts(None) == (0, 0, 0, 0, 0)


def test_field_on_held_out_labels(spark):
    d, lab = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    field = quality_rules.train(d, lab.where("doc_id % 2 = 0"))
    rows = quality_rules.judge(d, field).join(lab.where("doc_id % 2 = 1"), "doc_id").collect()
    good = [r["kept"] or r["base_failed"] for r in rows if r["quality"] == 1]
    bad = [not r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) > 0.9
    texts = {r["doc_id"]: r["text"] for r in d.collect()}
    ends = {v: [texts[r["doc_id"]] for r in rows if r["kept"] == bool(v) and len((texts[r["doc_id"]] or "").split("\n")) > 5][:40] for v in (0, 1)}
    mixed = [quality_rules.verdict(a + "\n" + b, field)[-2] for a, b in zip(ends[1], ends[0], strict=False)]
    assert len(mixed) >= 5 and sum(0 < x < 1 for x in mixed) >= 0.8 * len(mixed)
    untrained = quality_rules.train(d, lab.limit(0))
    assert quality_rules.judge(docs(spark, "one two three four five six seven eight nine ten", None, ""), untrained).select("kept").collect() == [(True,), (False,), (False,)]


def test_viterbi_against_enumeration():
    rng = np.random.default_rng(8)
    f = quality_rules.LineField(rng.normal(size=(quality_rules.N_FEATURES, 2)), rng.normal(size=(2, 2)))
    bins, _ = quality_rules.line_features("AAA!!\nsome words here.\n| x | y\n12 34\nmore of it")
    s = f.scores(bins)
    paths = [[(k >> i) & 1 for i in range(len(s))] for k in range(2 ** len(s))]
    best = max(paths, key=lambda p: sum(s[i, x] for i, x in enumerate(p)) + sum(f.transitions[a, b] for a, b in zip(p, p[1:], strict=False)))
    assert f.viterbi(bins).tolist() == best


# surrogates


def test_surrogates(spark):
    t = "mail bosbt.42@mail8.example.com, +1 (555) 123-4567, 4111 1111 1111 1111, 42.144.35.254. Frau Anna Smith, Mr. Ivan Petrov; bosbt.42@mail8.example.com"
    new, spans = pii.replace(t, "k")
    assert [k for *_, k, _ in spans] == ["email", "phone", "card", "ip", "name_f", "name_m", "email"]
    assert spans[0][3] == spans[-1][3] and all(t[s:e] not in new for s, e, *_ in spans)
    assert spans[4][3].split()[0] in pii.GIVEN["f", "latin"] and len(new.split()) == len(t.split())
    card = "".join(c for c in spans[2][3] if c.isdigit())
    assert pii._luhn(card[:-1]) == card[-1]
    assert pii.replace("Nothing here, 3.14 or 2024-01-02.", "k")[1] == []
    for m in (2, 7, 100, 1000):
        p = pii.Permutation(m, "k", "t")
        assert sorted(map(p, range(m))) == list(range(m)) and all(p(x) != x for x in range(m))
    names = [n for g in pii.GIVEN.values() for n in g] + ["Zora", "Xnna", "Annu"]
    assert len({pii.surrogate("name_f", n, "k") for n in names}) == len(names)
    df = spark.createDataFrame([(1, t, 1), (2, None, 2), (3, "", 3), (1, t, 1)], "doc_id long, text string, entities int")
    out = pii.pseudonymize(df, "k")
    got = out.collect()
    assert out.columns == ["doc_id", "text", "entities", "entities_"] and [r["entities"] for r in got] == [1, 2, 3, 1]
    assert got[0]["text"] == new == got[3]["text"] and got[1]["text"] is None and got[2]["text"] == "" and len(got[0]["entities_"]) == 7
    d = spark.read.parquet(f"{SF}/documents.parquet")
    assert pii.collisions(d, pii.pseudonymize(d, "k")).count() == 0
    assert pii.pseudonymize(d.limit(0), "k").count() == 0
    with pytest.raises(ValueError, match="key"):
        pii.pseudonymize(d, "")


def test_spellings_of_one_entity():
    digits = lambda x: "".join(c for c in x if c.isdigit())
    phones = [pii.surrogate("phone", x, "k") for x in ("+1 (555) 123-4567", "+15551234567", "(555) 123-4567", "555-123-4567")]
    assert {digits(x)[-10:] for x in phones} == {digits(phones[0])[-10:]} and digits(phones[0])[-10:] != "5551234567" and phones[1].startswith("+1")
    assert len({digits(pii.surrogate("phone", x, "k")) for x in ("+49 30 1234567", "+49301234567")}) == 1
    new, _ = pii.replace("Dr. Petrov met Mr. Ivan Petrov. Later Petrov left, and Ivan too. Petrovka stays.", "k")
    words = new.replace(".", "").replace(",", "").split()
    assert words[1] == words[5] == words[7] and words[4] == words[10] and "Petrov " not in new and "Ivan" not in new and words[-2] == "Petrovka"
    new, spans = pii.replace("Ms. 王芳 spoke, 王芳 again; κύριος", "k")
    assert "王芳" not in new and len(spans) == 2 and spans[0][3] == spans[1][3] and all(ord(c) in pii.HAN for c in spans[0][3])
    local = "a1." * 160 + "x"
    new, spans = pii.replace(f"to {local}@mail.example.com", "k")
    assert len(spans) == 1 and spans[0][0] == 3 and local[:40] not in new
    many = " ".join(f"u{i}@example.com" for i in range(12_000))
    assert len(pii.replace(many, "k")[1]) == 12_000


# pipeline


def test_pipeline(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "pii_surrogates", "packing"]
    d = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, d = d, shared.cut(stage(spark, d, SF))
        assert d.columns == before.columns and 0 < d.count() <= before.count()
        assert d.join(before, "doc_id", "left_anti").count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, d, SF)
    assert last.select("doc_id").distinct().count() == d.count()

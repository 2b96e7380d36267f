"""The corpus operators against brute force, round trips and held-out rows, on small tables with odd cases."""

import base64
import collections
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import bpe, components, decontam, html_text, langid, lm, mil, near_dup, quality_rules, secrets_scan, shards, word_contexts, words

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def prose(r, n, vocabulary=400, prefix="w"):
    return " ".join(f"{prefix}{r.randrange(vocabulary)}" for _ in range(n))


def docs(spark, texts, sources=None):
    rows = [(i, t, "en", sources[i] if sources else "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture()
def odd(spark):
    """Nulls, empty and blank texts, repeated rows, a very long text, and clashing extra columns."""
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, "one", "en", None), (4, "one", "en", None),
            (None, "no id here", "de", "b"), (5, "ab " * 40_000, "en", "a"), (6, "naïve 日本 text\nline", None, "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumns(
        {c: F.lit(7) for c in ("kept", "ids", "_row", "n", "cls", "score", "h")})


def test_bpe_equals_the_public_encoder(spark):
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    theirs = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(1)
    texts = ["", "a" * 5000, "it's  the\n\n end ", "日本é ß x"] + ["".join(r.choice("aabetiones  \n0123.,!éß'stll") for _ in range(60)) for _ in range(300)]
    out = bpe.encode(docs(spark, [*texts, None]), PATH, PATTERN, keep=["doc_id"], decoded="decoded").orderBy("doc_id").collect()
    assert [x.ids for x in out] == [theirs.encode_ordinary(t) for t in texts] + [[]]
    assert [bytes(x.decoded) for x in out] == [t.encode() for t in texts] + [b""]
    again = bpe.decode(spark.createDataFrame([(x.ids,) for x in out], "ids array<int>"), PATH, PATTERN)
    assert sorted(bytes(x.decoded) for x in again.collect()) == sorted(t.encode() for t in [*texts, ""])


def test_html_main_text(spark):
    page = ("<html><head><title>T</title><style>p{}</style></head><body><nav><a href=/>Menu</a></nav><div class='tpl'><b>Join</b> us</div>"
            "<div class=ad>Buy</div><article><h1>Head {i}</h1><p>Fish &amp; chips {i}<p>More&nbsp;text {i}<script>x='</p>'</script>"
            "<div class='comments'>nice!</div></article><footer>(c)</footer></body></html>")
    bare = "<body><div>Our motto since 1900</div><p>Body {i} one</p><ul><li>a{i}<li>b{i}</ul></body>"
    rows = [(i, "http://a.org/x", page.replace("{i}", str(i))) for i in range(10)]
    rows += [(i, "http://b.org/y", bare.replace("{i}", str(i))) for i in range(10, 30)] + [(99, None, None), (98, "x", "<p>open <b>bold")]
    out = {r.page_id: r.text for r in html_text.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[3] == "Head 3\nFish & chips 3\nMore text 3" and out[12] == "Body 12 one\na12\nb12" and out[99] == "" and out[98] == "open bold"


@pytest.mark.parametrize("limit", [0, html_text.BROADCAST_ROWS])
def test_html_templates_inside_articles(spark, limit):
    """A box that recurs inside a host's articles goes; copies, near copies and the articles' own recurring paragraphs stay."""
    r = random.Random(9)
    page = lambda i, *parts: f"<body><p>Menu {i}</p><article><h1>Head {i}</h1>{''.join(parts)}</article></body>"
    box, own = "<div class=x7><p>Read this too</p></div>", "<p>Yours truly, the editor</p>"
    body = [f"<p>{prose(r, 20)}</p>" for _ in range(6)]
    rows = [(i, "http://a.org/", page(i, f"<p>{prose(r, 30)}</p>", box, own if i < 12 else "", f"<p>{prose(r, 9)}</p>")) for i in range(40)]
    rows += [(40, "http://a.org/", page(40, box, "<p>Short</p>")), (41, "http://c.org/", page(41, box, "<p>Other host</p>"))]
    rows += [(i, "http://b.org/", page(i, *body[:i % 6], f"<p>changed {i}</p>", *body[i % 6 + 1:])) for i in range(100, 130)]
    rows += [(i, "http://d.org/", page(0, *body)) for i in range(200, 220)]
    out = {x.page_id: x.text for x in html_text.extract(
        spark, spark.createDataFrame(rows, "page_id long, url string, html string"), broadcast_rows=limit).collect()}
    whole = lambda i: re.sub("<[^>]+>", "", re.sub("</(p|h1)>", "\n", re.search("<article>(.*)</article>", {x[0]: x[2] for x in rows}[i])[1])).strip()
    assert all(out[i] == whole(i).replace("Read this too\n", "") for i in range(41))
    assert all(out[i] == whole(i) for i in [41, *range(100, 130), *range(200, 220)])


def brute_components(texts, size):
    sets = []
    for t in texts:
        w = WORDS.findall((t or "").lower())
        sets.append(frozenset(zip(*(w[i:] for i in range(size)))) if len(w) >= size else frozenset([tuple(w)]) if w else frozenset())
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = root[i], root[j]
                root = [min(x, y) if k in (x, y) else k for k in root]
    return [len(s) for s in sets], root


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(spark, size):
    r = random.Random(size)
    base = prose(r, 260).split()
    texts = [prose(r, n) for n in (1, 3, 12, 40, 120, 150, 300)] + ["one", "one", "", None, " "]
    for _ in range(60):  # one group whose members differ more and more
        w = list(base)
        for _ in range(r.randrange(24)):
            w[r.randrange(len(w))] = f"e{r.randrange(50)}"
        texts.append(" ".join(w))
    for n in (30, 110, 126, 140):
        w = prose(r, n).split()
        texts += [" ".join(w), " ".join(w + ["end"] * (n // 10)), " ".join(w[n // 8:])]
    out = near_dup.link(spark, docs(spark, texts), size).orderBy("doc_id").collect()
    n, root = brute_components(texts, size)
    assert [x.n_shingles for x in out] == n and [x.component_id for x in out] == root
    assert [x.kept for x in out] == [i == c for i, c in enumerate(root)]


def test_unlike_texts_of_short_lists_are_not_read(spark, monkeypatch):
    """Seven passages and seven texts of three, any two texts with one in common: each list holds three classes, none of them alike."""
    r, read = random.Random(6), []
    passages = [" ".join(f"w{r.randrange(10**9)}" for _ in range(60)) for _ in range(7)]
    texts = [" ".join(passages[int(k)] for k in of) for of in ("012", "034", "056", "135", "146", "236", "245")]
    own = near_dup._texts
    monkeypatch.setattr(near_dup, "_texts", lambda need, *more: read.append(need.count()) or own(need, *more))
    out = near_dup.link(spark, docs(spark, texts), 2).orderBy("doc_id").collect()
    assert [x.component_id for x in out] == [x.doc_id for x in out] and sum(read) == 0


def test_long_texts_inside_one_another_share_a_key():
    """J of 0.8, one set inside the other, its further shingles the rarest and the shared ones of random rarity."""
    r = np.random.default_rng(11)
    for _ in range(4000):
        counts = r.integers(1 << 10, 1 << 30, near_dup.BUCKETS)
        large = r.integers(0, 1 << 63, 1000, np.uint64)
        counts[(large[800:] % np.uint64(near_dup.BUCKETS)).astype(np.int64)] = 1
        s, t = np.sort(large[:800]), np.sort(large)
        assert len(np.intersect1d(near_dup.keys(s, counts), near_dup.keys(t, counts)))


def test_short_texts_share_a_key_whatever_the_order():
    r = np.random.default_rng(13)
    for _ in range(2000):
        n = int(r.integers(1, near_dup.SMALL + 9))
        large = r.integers(0, 1 << 63, n, np.uint64)
        s = np.sort(large[n // int(r.integers(5, 12)):])
        counts = r.integers(1, 1 << 30, near_dup.BUCKETS)
        t = np.sort(large)
        assert not near_dup.similar(s, t) or len(np.intersect1d(near_dup.keys(s, counts), near_dup.keys(t, counts)))


def test_unlike_texts_of_few_words_meet_in_few_lists(spark):
    """Word pairs that a fixed share of all texts holds: lists under the rarest of them grew with the corpus, rows with its square."""
    def in_lists(n):
        r = random.Random(14)
        rows = docs(spark, [prose(r, 150, vocabulary=60) for _ in range(n)])
        found = near_dup.postings(rows, "doc_id", "text", 2, near_dup.rarity(rows, "text", 2))
        return near_dup._shared(found).count()
    assert in_lists(400) < 40


def test_signatures_never_drop_similar_sketches():
    r = np.random.default_rng(12)
    for shared in (20, 80, 100, 128):
        for _ in range(200):
            both = r.integers(0, 1 << 63, 256 - shared, np.uint64)
            a, b = both[:128], both[128 - shared:]
            differing = np.bitwise_count((near_dup.signature(a) ^ near_dup.signature(b)).view(np.uint64)).sum()
            assert differing <= 2 * (128 - shared) and (shared > 20 or differing > 2 * (128 - near_dup.AGREE))


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (200, 300), (300, 250), (5, 5)]
    out = {r.node: r.component for r in components.components(spark, spark.createDataFrame(chain, "a long, b long")).collect()}
    assert out == {i: 0 for i in range(1, 41)} | {101: 100, 250: 200, 300: 200}
    assert components.components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_merged_equal_those_of_all_links(spark):
    r = random.Random(15)
    first, more = ([(r.randrange(200), r.randrange(200)) for _ in range(n)] for n in (90, 60))
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    labelled = lambda df: sorted((x.node, x.component) for x in df.collect())
    found = components.components(spark, frame(first))
    assert labelled(components.merged(spark, found, frame(more))) == labelled(components.components(spark, frame(first + more)))
    assert labelled(components.merged(spark, found, frame(first))) == labelled(found)


def test_lm_base_is_exact_and_the_model_is_a_distribution(spark):
    r = random.Random(4)
    texts = [prose(r, 80, 60) for _ in range(60)] + ["", None, "unseen words here"]
    d = docs(spark, texts).withColumn("learn", F.col("doc_id") < 50)
    out = lm.score(spark, d, "learn", ["doc_id"], label="lang").orderBy("doc_id").collect()
    tokens = [WORDS.findall((t or "").lower()) for t in texts]
    c = collections.Counter(w for t in tokens[:50] for w in t)
    n, v = sum(c.values()) + 50, len(c) + 1
    for x, t in zip(out, tokens, strict=True):
        want = sum(np.log10(c[w] + 0.1) for w in t) + np.log10(50.1) - (len(t) + 1) * np.log10(n + 0.1 * (v + 1))
        assert (x.n_tokens, x.n_known, x.train_tokens) == (len(t) + 1, sum(w in c for w in t) + 1, n) and abs(x.base_score - want) < 1e-6
        assert x.score < 0
    blind = sum(len((t or "").encode()) + 1 for t in texts[50:60]) * np.log10(1 / 256)
    assert sum(x.score for x in out[50:60]) > 0.6 * blind  # held out, far better than bytes at random


def test_lm_knows_the_words_before(spark):
    r = random.Random(21)
    follows = {f"w{i}": [f"w{r.randrange(200)}" for _ in range(2)] for i in range(200)}

    def chain(n):
        out = ["w0"]
        while len(out) < n:
            out.append(r.choice(follows[out[-1]]))
        return out

    texts = [chain(100) for _ in range(400)]
    shuffled = [r.sample(t, len(t)) for t in texts[320:]]
    d = docs(spark, [" ".join(t) for t in texts + shuffled]).withColumn("learn", F.col("doc_id") < 320)
    out = {x.doc_id: x for x in lm.score(spark, d, "learn", ["doc_id"], label="lang").collect()}
    ordered, mixed = (sum(out[i].score for i in range(a, a + 80)) for a in (320, 400))
    base = sum(out[i].base_score for i in range(320, 400))
    assert sum(out[i].base_score for i in range(400, 480)) == pytest.approx(base)  # the same words
    assert ordered > 0.35 * base > 0.8 * base > mixed  # one bit a word, not eight; out of order they surprise


def test_word_contexts_counted_as_by_hand():
    r = np.random.default_rng(5)
    n = r.integers(2, 50, 40).astype(float)
    code = word_contexts.Code(n, np.zeros((40, 0)))
    assert sum(2.0 ** -code.size.astype(float)) == 1 and len(set(zip(code.bits.tolist(), code.size.tolist()))) == 40
    assert all(code.counts[code.nodes[s - 1][w], 0] == n[w] for w, s in enumerate(code.size.tolist()))
    # A held-out word in a known context: the bits' probabilities sum to one over all words.
    rank, context = np.tile(np.arange(40), 2), np.repeat(np.array([7, 9], np.uint32), 40)
    seen = np.array([3, 3, 3, 5, 11], np.int32)
    what = np.concatenate((rank << 5, seen << 5 | 1)).astype(np.int32)
    context = np.concatenate((context, np.full(5, 7, np.uint32)))
    got = 10 ** word_contexts.costs(context, what, np.zeros(len(what), np.uint16), code)
    assert got[:40].sum() == pytest.approx(1, abs=1e-4) and got[40:80].sum() == pytest.approx(1, abs=1e-4)
    assert got[3] > 2 * got[43] and got[3] > got[80]  # known here; the words of training texts are coded without themselves


def test_word_contexts_survive_packing():
    words_of = next(words.blocks(pa.array(["a b a b", "", "b a c", "a b"])))[2]
    h = {w.tobytes(): k for k, w in enumerate(np.unique(words_of.hashes))}
    rank = np.array([h[x.tobytes()] for x in words_of.hashes])
    none = np.full(9, -1)
    found = [(task, *map(list, word_contexts.unpack(b))) for task, b in word_contexts.pack(
        words_of, rank, none, none[:4], np.array([1, 0, 1, 0]), np.array([1] * 9 + [3]), 5, 2)]
    rows = collections.Counter((d, w >> 5, w & 1) for _, _, what, _, doc in found for w, d in zip(what, doc, strict=True))
    first = words_of.first.tolist()
    want = collections.Counter((d, int(k), int(d % 2 == 0)) for d in range(4) for k in [*rank[first[d]:first[d + 1]], 6])
    assert rows == want
    row, cost = word_contexts.unpack_sums(word_contexts.pack_sums(np.array([9, 2, 9]), np.array([1.0, 2.0, 3.0])))
    assert row.tolist() == [2, 9] and cost.tolist() == [2, 4]


def test_language_id_held_out(spark):
    words = {"en": "the of and with that from ing tion".split(), "de": "der die und nicht über schön straße".split(), "fr": "le où était garçon être pour".split()}
    r = random.Random(2)
    rows = [(i, " ".join(r.choice(words[k]) for _ in range(20)), k) for i in range(60) for k in words] + [(0, None, "en"), (1, "12 34!", "en"), (2, "und", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = langid.predict(spark, d, F.col("doc_id") % 3 != 1, ["doc_id", "lang", "text"]).collect()
    full = [x for x in out if x.text and len(x.text) > 10]
    assert all(x.lang_pred == x.lang for x in full) and all(0 <= x.score <= 1 for x in out)
    assert {x.lang_pred for x in out if x.text in (None, "12 34!")} == {"und"}
    assert {x.lang_pred for x in langid.predict(spark, d.limit(0), F.lit(True), ["doc_id"]).collect()} == set()


def test_shards(spark):
    r = random.Random(3)
    texts = [prose(r, r.randrange(1, 400)) for _ in range(600)] + ["hot " * 50] * 400 + [None, "", "x" * 200_000]
    out = shards.shard(spark, docs(spark, texts)).collect()
    assert sorted(x.doc_id for x in out) == list(range(len(texts)))
    by = collections.defaultdict(list)
    for x in out:
        t = (texts[x.doc_id] or "").encode()
        assert (x.size, x.text_crc32, x.law, x.grown_shard) == (len(t) + 16, zlib.crc32(t), "bytes", None)
        by[x.shard].append(x)
    assert all(sorted(y.slot for y in rows) == list(range(len(rows))) for rows in by.values()) and set(by) <= set(range(40))
    total = sum(x.size for x in out)
    biggest = max(x.size for x in out)
    assert all(sum(y.size for y in rows) <= total / 40 + biggest for rows in by.values())
    again = {x.doc_id: (x.shard, x.slot) for x in shards.shard(spark, docs(spark, texts)).collect()}
    assert again == {x.doc_id: (x.shard, x.slot) for x in out}


def test_secret_spans_equal_regexes():
    scan = secrets_scan.scanner(secrets_scan.RULES)
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    r = random.Random(1)
    parts = ["password", "Token", "secret", "API_key", '"', "'", " ", ":", "=", "AKIA", "AKIAABCD12345678", "abcdef0123", "xyzXYZ123+/", "é", "日本", "-", "9" * 12, "\n"]
    for _ in range(3000):
        t = "".join(r.choice(parts) for _ in range(r.randrange(25)))
        want = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 12]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        got = [(s["start"], ["assign", "access", "hex"].index(s["kind"]), s["end"]) for s in scan.spans(t) if s["kind"] in ("assign", "access", "hex")]
        assert got == sorted(want), t
    assert [s["kind"] for s in scan.spans("ghp_" + "a1B" * 12 + " -----BEGIN RSA PRIVATE KEY-----\n" + "QUJD" * 8)] == ["github", "private_key"]


def test_redaction_merges_overlapping_spans(spark):
    out = {x.doc_id: (x.text, x.n_chars) for x in secrets_scan.redact(docs(spark, ["é token = 'aaaabbbbccccdddd0123' ok", "plain", None])).collect()}
    assert out == {0: ("é [SECRET]' ok", 14), 1: ("plain", 5), 2: (None, 0)}


def test_quality_rules_lines(spark):
    r = random.Random(5)
    line = "accept our cookies to go on reading this page of ours"
    texts = [f"{prose(r, 30, 5000)}\n{line}\n{prose(r, 30, 5000)}" for _ in range(30)] + [f"{prose(r, 9, 5000)}\n{line}\n{line} {i}" for i in range(3)]
    texts += ["\n".join(prose(random.Random(1), 30, 5000) for _ in range(3))] * 40 + ["a b c d e f g h " * 10, None, ""]
    d = docs(spark, texts)
    out = {x.doc_id: x for x in quality_rules.verdicts(spark, d, ["doc_id"]).collect()}
    assert all(out[i].kept and out[i].n_line_words == 11 for i in range(30))        # the line goes, the texts stay
    assert not any(out[i].kept for i in range(30, 33)) and out[35].n_dup_lines == 2  # depleted
    assert out[73].n_repeat_words == 80 and out[73].base_failed and not out[74].kept and out[75].n_words == 0
    left = {x.doc_id: x for x in quality_rules.clean(spark, d).collect()}
    assert set(left) == {i for i, x in out.items() if x.kept} and line not in left[0].text and left[0].n_chars == len(left[0].text)


def test_decontamination_finds_reordered_passages(spark):
    r = random.Random(6)
    items = [prose(r, 40, 3000, "q") for _ in range(5)] + ["too short", None]
    w = items[1].split()
    texts = [f"{prose(r, 100)} {items[0].upper()} {prose(r, 50)}", " ".join([prose(r, 9), *w[20:], prose(r, 30), *w[:20]]),
             " ".join([prose(r, 60), *items[2].split()[:12]]), prose(r, 300), None, "", items[3].replace(" ", ", ")]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    out = {(x.doc_id, x.item_id): (x.coverage, x.n_tiles) for x in decontam.contaminated(spark, docs(spark, texts), bench).collect()}
    assert out == {(0, 0): (1.0, 1), (1, 1): (1.0, 2), (6, 3): (1.0, 1)}
    assert decontam.contaminated(spark, docs(spark, texts), bench.limit(0)).count() == 0


def test_only_copies_and_contaminated_rows_go(spark):
    """Null and repeated ids take no other texts with them."""
    r = random.Random(10)
    t = [prose(r, 60, 5000) for _ in range(6)]
    item = prose(r, 40, 3000, "q")
    rows = [(1, t[0]), (None, t[0] + " end"), (None, t[1]), (None, t[2]), (None, t[2] + " end"), (7, t[3]), (7, t[4]), (7, t[4]), (9, t[3] + " end"), (None, None)]
    out = near_dup.one_of_each(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    third = [x for x in out if (x.text or "").startswith(t[2])]
    assert len(third) == 1 and sorted(((x.doc_id, x.text) for x in out if x not in third), key=key) == sorted(
        [(1, t[0]), (None, t[1]), (7, t[3]), (7, t[4]), (None, None)], key=key)
    rows = [(None, t[0]), (None, f"{t[1]} {item}"), (5, t[2]), (5, item), (6, item), (None, None)]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = decontam.clean(spark, spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert sorted(((x.doc_id, x.text) for x in out), key=key) == sorted([(None, t[0]), (5, t[2]), (None, None)], key=key)


def test_quality_classifier_held_out(spark):
    r = random.Random(7)
    good = [prose(r, r.randrange(30, 300)) for _ in range(200)]
    texts = [" ".join(f"{w}###" if i % 2 else w for w in t.split()) if i % 2 else t for i, t in enumerate(good)] + ["", None]
    labels = spark.createDataFrame([(i, (i + 1) % 2) for i in range(200)], "doc_id long, quality int")
    out = mil.score(spark, docs(spark, texts), labels, F.col("doc_id") % 5 != 0, ["doc_id"]).collect()
    assert all((x.score >= 0.3) == (x.doc_id % 2 == 0) for x in out if x.doc_id < 200) and all(0 <= x.score <= 1 for x in out)
    assert {x.score for x in mil.score(spark, docs(spark, texts), labels.limit(0), F.lit(True), ["doc_id"]).collect()} == {0.5}


def test_odd_rows_and_empty_tables(spark, odd):
    bench = spark.createDataFrame([(1, "ab ab ab ab ab ab")], "item_id long, text string")
    flags = odd.withColumn("learn", F.lit(True))
    labels = spark.createDataFrame([(2, 1), (4, 0), (None, 1)], "doc_id long, quality int")
    whole = [lambda d: near_dup.link(spark, d, 2), lambda d: shards.shard(spark, d), lambda d: lm.score(spark, d.withColumn("learn", F.lit(True)), "learn", ["doc_id"]),
             lambda d: langid.predict(spark, d, F.lit(True), ["doc_id"]), lambda d: secrets_scan.find(d), lambda d: bpe.encode(d, PATH, PATTERN),
             lambda d: quality_rules.verdicts(spark, d, ["doc_id"]), lambda d: mil.score(spark, d, labels, F.lit(True), ["doc_id"])]
    for f in whole:
        assert f(flags).count() == 8 and f(flags.limit(0)).count() == 0
    for f in (lambda d: near_dup.one_of_each(spark, d), lambda d: quality_rules.clean(spark, d), secrets_scan.redact, lambda d: decontam.clean(spark, d, bench)):
        assert f(odd).columns == odd.columns and f(odd.limit(0)).count() == 0
    assert near_dup.one_of_each(spark, odd).where("doc_id = 4").count() == 1


def test_pipeline_small(spark, scratch):
    r = random.Random(8)
    texts = [prose(r, 60) for _ in range(20)]
    items = prose(r, 40, 3000, "q")
    texts += [texts[0], texts[1] + " end", f"{prose(r, 80)} {items}", "short", None, f"{prose(r, 40)} token = 'abcdefghijklmnop1234'"]
    docs(spark, texts).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(1, items)], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    out = {x.doc_id: x for x in corpus_pipeline.run(spark, scratch).collect()}
    assert set(out) == {*range(20), 25}
    c = bpe.codec(PATH, PATTERN)
    assert c.decode(out[3].ids).decode() == texts[3] and c.decode(out[25].ids).decode().endswith("[SECRET]'")


def test_quality_rules_equal_their_sql(spark):
    from ledgerlake.llm import queries
    from oracle_compare import compare, duck_connection

    name, sf_dir = "op8_quality_rules", "/root/testdata/sf0.01"
    r = compare(spark, duck_connection(sf_dir), name, queries.QUERIES[name](spark, sf_dir), queries.ORACLE_SQL[name])
    assert r["ok"], r

"""The ten operators against brute force on small tables, and on odd tables."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from quarry.llm import (bpe, decontaminate, html_wrappers, language_id, line_dedup, near_dedup, quality_model, quality_rules,
                        suffix_dedup, toxicity)
from quarry.llm.common import crc_of

RNG = random.Random(5)


def prose(n, seed, words=4000):
    r = random.Random(seed)
    return [f"w{r.randrange(words)}" for _ in range(n)]


# ---------------------------------------------------------------- 2 BPE

def test_bpe_equals_the_public_library():
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern = bpe.default_vocabulary()
    own = bpe.codec(path, pattern)
    other = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=own.ranks, special_tokens={})
    texts = ["".join(RNG.choice("aab  \n\tthe1é中xing!#' \x1c　²sll\x85") for _ in range(RNG.randint(0, 80))) for _ in range(1500)]
    texts += ["a" * 30_000, "ab" * 9000, " " * 5000, "\0", "", "don't  stop\n\n now", "<|endoftext|>"]
    for t in texts:
        ids = own.encode(t)
        assert ids == other.encode_ordinary(t)
        assert own.decode(ids) == t.encode()


def test_bpe_memory_is_bounded():
    m = bpe.Memory(3 * bpe.ENTRY)
    for i in range(50):
        m.put(str(i), b"%d" % i)
    assert len(m.new) + len(m.old) <= 6 and m.get("49") == b"49"
    m.clear()
    assert m.get("49") is None


def test_bpe_caches_outlive_a_partition_only_while_work_comes(monkeypatch):
    import time
    monkeypatch.setattr(bpe, "IDLE", 0.2)
    own = bpe.codec(*bpe.default_vocabulary())
    own.encode("some words that are remembered")
    own.rest()
    assert bpe.codec(*bpe.default_vocabulary()).units.new and own.timer is None
    time.sleep(0.4)
    assert own.units.new
    own.rest()
    time.sleep(0.4)
    assert not own.units.new and not own.pieces.new


def test_an_idle_worker_lets_go_of_its_codec(monkeypatch):
    import time
    monkeypatch.setattr(bpe, "IDLE", 0.2)
    where = bpe.default_vocabulary()
    own = bpe.codec(*where)
    known = own.encode("some words, whole or not")
    own.rest()
    assert bpe.codec(*where) is own                     # the next partition comes in time
    own.rest()
    time.sleep(0.6)
    assert own not in bpe._codecs.values() and not own.units.new
    assert bpe.codec(*where).encode("some words, whole or not") == known == own.encode("some words, whole or not")
    assert 4 * bpe.CACHE_BYTES < 200_000_000            # two generations in each of an executor's two workers


def test_bpe_queue_is_empty_after_each_merge():
    own = bpe.codec(*bpe.default_vocabulary())
    for _ in range(200):
        own.merge("".join(RNG.choice("abc e") for _ in range(RNG.randint(2, 60))).encode())
        assert not any(own.leaves) and not any(own.buckets)


def test_bpe_query_shape(odd):
    rows = bpe.bpe_digest(odd, *bpe.default_vocabulary()).collect()
    assert len(rows) == odd.count()
    nothing = hashlib.sha256(b"").hexdigest()
    for r, t in zip(sorted(rows, key=repr), sorted(odd.select("doc_id", "text").collect(), key=repr), strict=False):
        if r.n_tokens == 0:
            assert r.ids_sha256 == r.decoded_sha256 == nothing
    assert Counter(r.decoded_sha256 for r in rows) == Counter(hashlib.sha256((t.text or "").encode()).hexdigest()
                                                              for t in odd.select("text").collect())
    path, pattern = bpe.default_vocabulary()
    back = bpe.bpe_decode(bpe.bpe_encode(odd, path, pattern), path, pattern).collect()
    assert Counter(bytes(r.data) for r in back) == Counter((t.text or "").encode() for t in odd.select("text").collect())


# ---------------------------------------------------------------- 3 quality rules

def brute_repeat(words):
    seen = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = set()
    for i in range(len(words) - 7):
        if seen[tuple(words[i:i + 8])] > 1:
            hit |= set(range(i, i + 8))
    return len(hit)


def test_quality_counts_against_brute_force():
    import re
    import zstandard
    z = zstandard.ZstdCompressor(level=3)
    for _ in range(300):
        text = "".join(RNG.choice(["a ", "b ", "c#", "\n", " ", "é ", "| ", "a b c d e f g h ", "\x1c"]) for _ in range(RNG.randint(0, 60)))
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        n, chars, symbols, dup, rep, failed, kept, *_ = quality_rules.judge(text, z)
        assert (n, chars, symbols) == (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"))
        assert dup == len(lines) - len(set(lines)) and rep == brute_repeat(words)
        assert failed == (n < 20 or 100 * rep > 30 * n) and not (failed and kept)


def test_quality_bands_reject_repetition_and_noise():
    import base64
    import zstandard
    z = zstandard.ZstdCompressor(level=3)
    clean = " ".join(prose(800, 1))
    same = " ".join(f"{a} {b}" for a in "abcdefgh" for b in range(4)) + " ."
    loop = " ".join(["the quick brown fox jumps over a"] * 3 + [f"{i}" for i in range(40)])
    noise = " ".join(base64.b85encode(random.Random(i).randbytes(150)).decode() for i in range(60))
    assert quality_rules.judge(clean, z)[6]
    assert not quality_rules.judge("\n".join(["a b c"] * 9 + [same] * 30), z)[6]
    assert not quality_rules.compression(noise.encode() * 1 + random.Random(3).randbytes(9000), z)[2]
    assert loop


def test_quality_bands_reject_encoded_text():
    import base64
    import zstandard
    z = zstandard.ZstdCompressor(level=3)
    r = random.Random(4)
    text = lambda word, size: " ".join(word() for _ in range(size // 13 + 1))[:size]
    encoded = lambda: base64.b64encode(r.randbytes(9)).decode()
    letters = lambda: "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=12))
    assert not any(quality_rules.judge(text(encoded, n), z)[6] for n in (300, 600, 1500, 3000, 5000, 9000, 40_000))
    assert not any(quality_rules.judge(text(letters, n), z)[6] for n in (2500, 5000, 9000, 40_000))
    assert not any(quality_rules.judge(text(lambda: r.randbytes(6).hex(), n), z)[6] for n in (20_000, 40_000))
    # Chunks of texts that are not much longer than one, and the end of a text.
    clean = " ".join(prose(800, 1))[:4096]
    assert quality_rules.judge(clean + " " + " ".join(prose(800, 2))[:3000], z)[6]
    assert quality_rules.compression((clean + text(encoded, 3900)).encode(), z)[1:] == (1, False)
    assert quality_rules.compression(clean.encode() + b"x", z)[1:] == (0, True)


def test_quality_filter_keeps_columns(odd, table_of):
    out = quality_rules.quality_filter(odd)
    assert out.schema == odd.schema
    report = quality_rules.quality_report(odd)
    assert report.where("kept").count() == out.count()
    assert quality_rules.quality_filter(table_of([])).count() == 0


# ---------------------------------------------------------------- 4 and 9 classifiers

def toxic_table(spark, n=600):
    r = random.Random(3)
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = prose(60, i, 300) + ([r.choice(["scoundrel", "villainous", "villainy"]) for _ in range(2)] if bad else [])
        r.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 3 != 0), int(bad)))
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark, table_of, odd):
    docs, labels = toxic_table(spark)
    rows = toxicity.score(table_of(docs), toxicity.fit(table_of(docs), labels)).collect()
    held = [r for r in rows if r.held_out]
    assert held and {r.doc_id for r in held} == {i for i, _ in docs if crc_of(i) % 4 == 2}
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    assert all(e.doc_id % 1 == 0 and crc_of(e.doc_id) % 4 != 2 for r in rows for e in r.evidence)
    odd_rows = toxicity.score(odd, toxicity.fit(table_of(docs), labels)).collect()
    assert len(odd_rows) == odd.count() and all(0 <= r.score <= 1 for r in odd_rows)
    none = toxicity.fit(table_of([]), labels.limit(0))
    assert {r.score for r in toxicity.score(odd, none).collect()} == {0.0}


def rows_of(vectors):
    """Vectors given as dicts, as rows of (owner, term, weight)."""
    rows = [(i, t, x) for i, v in enumerate(vectors) for t, x in sorted(v.items())]
    return tuple(np.array([r[k] for r in rows], kind) for k, kind in enumerate((np.int64, np.int64, float)))


def test_block_max_search_is_exact():
    r = random.Random(1)
    for topics in (1, 40):      # of 40 topics the blocks have words of their own, and most are never completed
        vectors = []
        for i in range(900):
            v = {50 * (i * topics // 900) + t: r.random() for t in r.sample(range(50), r.randint(1, 8))}
            norm = sum(x * x for x in v.values()) ** 0.5
            vectors.append({t: x / norm for t, x in v.items()})
        r.shuffle(vectors)
        index = toxicity.BlockMaxIndex(900, *rows_of(vectors), 2000)
        queries = vectors[:300] + [{}, {1999: 1.0}]
        for q, (got, examples) in zip(queries, index.nearest(len(queries), *rows_of(queries), 10), strict=True):
            cosines = [min(1.0, sum(q.get(t, 0) * x for t, x in v.items())) for v in vectors]
            want = [w for w in sorted(cosines, reverse=True)[:10] if w > 0]
            assert np.allclose(got, want, atol=1e-5) and len(got) == len(want)
            assert np.allclose([cosines[e] for e in examples], got, atol=1e-5)
        if topics > 1:
            assert index.read < 0.5 * index.blocks


def test_equal_cosines_keep_the_first_places():
    index = toxicity.BlockMaxIndex(200, *rows_of([{0: 1.0}] * 200), 1)
    (cosines, examples), = index.nearest(1, *rows_of([{0: 1.0}]), 15)
    assert cosines.tolist() == [1.0] * 15 and examples.tolist() == index.example[:15].tolist()


def plain_terms(text):
    words = decontaminate.words_of(text)
    return [("", w) for w in words] + [(k, w[:k]) for w in words for k in toxicity.BEGINNINGS if len(w) > k]


def test_toxicity_evidence_against_brute_force(spark, table_of, monkeypatch):
    monkeypatch.setattr(toxicity, "PIECE", 100)
    docs, labels = toxic_table(spark, 240)
    docs += [(1000, None), (1001, ""), (1002, "w1 " * 3000 + "Scoundrel été"), (1003, docs[5][1])]
    model = toxicity.fit(table_of(docs), labels)
    held = {i: plain_terms(t) for i, t in docs}
    number = {t: k for k, t in enumerate(sorted({t for i in model.ids for t in held[i]}, key=str))}
    counts = {y: np.zeros(len(number) + 1) for y in (0, 1)}
    df = np.zeros(len(number))
    for i, terms in held.items():
        for t in set(terms) & number.keys():
            df[number[t]] += 1
            if i < 1000 and crc_of(i) % 4 != 2:
                counts[int(i % 4 == 0)][number[t]] += 1
    learned = [i for i in range(240) if crc_of(i) % 4 != 2]
    ones = sum(i % 4 == 0 for i in learned)
    weights = toxicity.term_weights(counts, len(learned) - ones, ones) * np.log(1 + len(docs) / np.maximum(1, df))

    def vector(terms):
        v = np.zeros(len(number))
        for t in terms:
            if t in number:
                v[number[t]] += 1
        v = np.where(v > 0, 1 + np.log(np.maximum(1, v)), 0) * weights
        return v / max(1e-30, np.sqrt(v @ v))

    examples = np.array([vector(held[i]) for i in model.ids])
    rows = {r.doc_id: r for r in toxicity.score(table_of(docs), model).collect()}
    assert rows.keys() == held.keys()
    for i, r in rows.items():
        cosines = examples @ vector(held[i])
        assert np.allclose([e.cosine for e in r.evidence], [c for c in sorted(cosines, reverse=True)[:3] if c > 0], atol=1e-5)
        assert all(abs(cosines[model.ids.index(e.doc_id)] - e.cosine) < 1e-5 for e in r.evidence)
    assert rows[1000].score == rows[1001].score and rows[1003].score == rows[5].score


def test_copies_of_examples_are_found_whatever_their_words(spark, table_of):
    docs, labels = toxic_table(spark)
    model = toxicity.fit(table_of(docs), labels)
    ids = set(model.ids)
    copies = [(10_000 + i, t) for i, t in docs if i in ids]
    rows = toxicity.score(table_of(copies), model).collect()
    assert len(rows) == len(ids) and {r.doc_id % 10_000 for r in rows} == ids
    assert all(r.evidence and r.evidence[0].doc_id == r.doc_id - 10_000 and r.evidence[0].cosine > 0.999 for r in rows)


def test_isotonic_rises():
    at, rate = toxicity.isotonic(np.array([0, 0, 1, 2, 3, 3.0]), np.array([0, 1, 0, 1, 1, 1.0]))
    assert (np.diff(rate) > 0).all() and (np.diff(at) > 0).all()


def test_trees_learn_and_match_a_plain_walk():
    r = np.random.default_rng(0)
    x = r.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] < -0.5)).astype(float)
    trees = quality_model.grow(x[:2000], y[:2000])
    assert ((trees.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.97
    margin = trees.base
    for f, t, v in zip(trees.feature, trees.threshold, trees.value, strict=True):
        node = 0
        for _ in range(quality_model.DEPTH):
            node = 2 * node + 1 + (x[0, f[node]] > t[node])
        margin += v[node - (2 ** quality_model.DEPTH - 1)]
    assert np.isclose(margin, trees.margin(x[:1])[0])
    assert quality_model.grow(np.zeros((0, 5)), np.zeros(0)).score(x[:2]).tolist() == [0.5, 0.5]


def test_quality_model_on_odd_rows(spark, table_of, odd):
    docs = [(i, " ".join(prose(80, i)) if i % 3 else "junk " * 90) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i, _ in docs] + [(0, None, None), (1, 0, 0)], "doc_id long, quality int, toxic int")
    trees = quality_model.fit(table_of(docs), labels)
    rows = quality_model.score(table_of(docs), trees).collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == (r.doc_id % 3 != 0) for r in held) >= 0.95 * len(held)
    got = quality_model.score(odd, trees).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert quality_model.score(table_of([]), quality_model.fit(table_of([]), labels)).count() == 0


# ---------------------------------------------------------------- 5 decontamination

def brute_matches(docs, bench):
    out = {}
    items = [(str(i), decontaminate.words_of(t)) for i, t in bench]
    for d, text in docs:
        words, hit, names = decontaminate.words_of(text), set(), set()
        for item, test in items:
            k = min(10, len(test))
            for a in range(len(test) - k + 1 if test else 0):
                for b in range(len(words) - k + 1):
                    if words[b:b + k] == test[a:a + k]:
                        hit |= set(range(b, b + k))
                        names.add(item)
        out[d] = (len(words), len(hit), sorted(names))
    return out


def test_decontamination_against_brute_force(spark, table_of):
    bench = [(1, " ".join(prose(30, 1))), (2, "Only FOUR words-here!"), (3, None), (4, ""), (5, " ".join(prose(12, 2))), (2, " ".join(prose(11, 9)))]
    docs = []
    for i in range(40):
        words = prose(60, 100 + i, 30)
        if i % 3 == 0:
            words[20:20] = prose(30, 1)[i % 19:i % 19 + 8 + i % 9]
        if i % 5 == 0:
            words += ["only", "four", "words", "here"]
        if i % 7 == 0:
            words += prose(12, 2) + prose(12, 2)[2:]
        docs.append((i, " ".join(words)))
    docs += [(50, None), (51, ""), (52, "ONLY four\twords  here")]
    items = spark.createDataFrame(bench, "item_id long, text string")
    want = brute_matches(docs, bench)
    rows = decontaminate.contamination(table_of(docs), items).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, hit, names = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(names), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
    clean = decontaminate.decontaminate(table_of(docs), items)
    assert clean.schema == table_of(docs).schema
    assert {r.doc_id for r in clean.collect()} == {d for d, (_, hit, _) in want.items() if not hit}


def test_decontamination_in_blocks_is_the_same(spark, table_of, monkeypatch):
    bench = [(i, " ".join(prose(20, i))) for i in range(6)]
    docs = [(i, " ".join(prose(40, 90 + i) + prose(20, i % 6)[:10 + i % 10] + prose(20, (i + 1) % 6))) for i in range(12)]
    items = spark.createDataFrame(bench, "item_id long, text string")
    whole = sorted(decontaminate.contamination(table_of(docs), items).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 150)
    assert sorted(decontaminate.contamination(table_of(docs), items).collect()) == whole
    kept = {r.doc_id for r in decontaminate.decontaminate(table_of(docs), items).collect()}
    assert kept == {r.doc_id for r in whole if not r.contaminated}


def test_decontamination_on_odd_rows(spark, odd):
    empty = spark.createDataFrame([], "item_id long, text string")
    rows = decontaminate.contamination(odd, empty).collect()
    assert len(rows) == odd.count() and not any(r.contaminated for r in rows)
    assert decontaminate.decontaminate(odd, empty).count() == odd.count()


def test_suffix_array_of_words():
    for _ in range(200):
        a = np.array([RNG.randint(0, 3) for _ in range(RNG.randint(1, 40))])
        assert decontaminate.suffix_array(a, 64).tolist() == sorted(range(len(a)), key=lambda i: a[i:].tolist())


# ---------------------------------------------------------------- 6 language

def test_cross_parsing_against_brute_force():
    texts = {"aa": "the cat sat on the mat and the dog", "bb": "le chat est sur la table et le chien"}
    parser = language_id.Parser(texts)
    folded = {k: "".join(map(chr, language_id.symbols(v, parser.symbol_of).tolist())) for k, v in texts.items()}
    for text in ["the dog sat", "le chien est la", "zzz", "the zebra ate le chat", "x", ""]:
        s = "".join(map(chr, language_id.symbols(text, parser.symbol_of).tolist()))
        want = []
        for k in sorted(texts):
            at = n = 0
            while at < len(s):
                size = 1
                while at + size < len(s) and s[at:at + size + 1] in folded[k]:
                    size += 1
                n, at = n + 1, at + size
            want.append(n)
        got = parser.phrases([language_id.symbols(text, parser.symbol_of)])[0].tolist()
        assert got == want, (text, got, want)


def test_language_held_out_and_odd(spark, table_of, odd):
    vocabulary = {"en": "the and of that with house water".split(), "de": "der und nicht mit haus wasser straße".split()}
    rows = [(i, " ".join(random.Random(i).choices(vocabulary[k], k=30)), k) for i, k in enumerate(["en", "de"] * 60)]
    rows += [(900, None, "en"), (901, "12 34 !!", "de"), (902, "the house", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in language_id.identify(docs, language_id.training_texts(docs)).collect()}
    assert all(out[i].lang_pred == k for i, t, k in rows[:120])
    assert out[900].lang_pred == out[901].lang_pred == "und" and out[902].lang_pred == "en"
    assert all(r.held_out == (crc_of(i) % 3 == 1) for i, r in out.items())
    got = language_id.identify(odd, language_id.training_texts(docs)).collect()
    assert len(got) == odd.count()
    none = language_id.identify(odd, {}).collect()
    assert {r.lang_pred for r in none} == {"und"}


# ---------------------------------------------------------------- 8 pages

def page(body, extra=""):
    return (f"<!DOCTYPE html><html><head><title>no</title><script>var a='<p>no</p>'</script></head><body><nav><ul><li><a href=x>no</a></li>"
            f"<li>no</li></ul></nav><!-- no --><div class='ad'>no</div>{body}{extra}<footer>no &copy;</footer></body></html>")


def test_pages_without_surroundings(spark):
    art = "<article><h1>Title &amp; more</h1><p><b>One<br>two  three<p>Four <i>five</i>\n six</p><ul><li>a</li><li>b</li></ul></article>"
    side = "<aside>no</aside><div id='comments'><p>no</p></div><form><label>no</label><input></form><div class='cookie-notice'><p>no</p></div>"
    cut = page(art).split("</p><ul>")[0]
    rows = [(1, "http://h/a", page(art)), (2, "http://h/b", page(art, side)), (3, "http://h/c", cut), (4, "http://h/d", None),
            (5, None, page(art)), (6, "http://h/e", ""), (7, "http://k/", page("<div class='story'><h2>T</h2><p>long text of the story</p><p>more of it</p></div>", side)),
            (8, "http://h/f", "plain < text & no markup"), (1, "http://h/a", page(art))]
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, main long, wrapper string")
    got = {r.page_id: r for r in html_wrappers.extract(pages, html_wrappers.wrappers(pages)).collect()}
    whole = "Title & more\nOne two three\nFour five six\na\nb"
    assert got[1].text == got[2].text == got[5].text == whole
    assert got[3].text == "Title & more\nOne two three\nFour five six"
    assert got[4].text == got[6].text == "" and got[7].text == "T\nlong text of the story\nmore of it"
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert html_wrappers.extract(pages.limit(0), html_wrappers.wrappers(pages.limit(0))).count() == 0


def extracted(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in html_wrappers.extract(pages, html_wrappers.wrappers(pages)).collect()}


def test_constant_text_in_neutral_elements_is_template(spark):
    body = lambda i: f"<p>story {i} begins here</p><p>and story {i} goes on</p>"
    rows = [(i, f"http://n/{i}", f"<html><body><div><p>Home</p><p>Shop at our partner</p></div><div>{body(i)}</div></body></html>")
            for i in range(8)]
    rows += [(100 + i, "http://copies/", f"<html><body><div>{body(1)}</div></body></html>") for i in range(5)]
    got = extracted(spark, rows)
    assert all(got[i] == f"story {i} begins here\nand story {i} goes on" for i in range(8))
    assert all(got[100 + i] == "story 1 begins here\nand story 1 goes on" for i in range(5))


def test_repeated_groups_choose_the_element_around_them(spark):
    parts = lambda i: "".join(f"<div class=head>part {k} of {i}</div><section>{' '.join(prose(40, 9 * i + k))}</section>" for k in range(3))
    got = extracted(spark, [(i, f"http://g/{i}", f"<html><body><div class=text>{parts(i)}</div></body></html>") for i in range(6)])
    assert all(f"part {k} of {i}" in got[i] for i in range(6) for k in range(3))


def test_every_layout_of_a_host_has_its_own_article(spark):
    rows = [(i, f"http://h/{i}", page(f"<article><p>article {i} {'x ' * 50}</p></article>")) for i in range(6)]
    rows += [(10 + i, f"http://h/{10 + i}", page(f"<div class=plain><p>plain text {i}</p></div>")) for i in range(3)]
    rows += [(20, "http://h/20", "plain < text & no markup"), (21, "http://h/21", page("<article></article><div><p>beside it</p></div>"))]
    rows += [(30 + i, f"http://k/{i}", page(f"<div class=big><p>{'many words ' * 30}{i}</p></div>")) for i in range(6)]
    rows += [(40 + i, f"http://k/{9 + i}", page(f"<div class=small><p>few words {i}</p></div>")) for i in range(3)]
    got = extracted(spark, rows)
    assert all(got[10 + i] == f"plain text {i}" and got[40 + i] == f"few words {i}" for i in range(3))
    assert got[20] == "plain < text & no markup" and got[21] == "beside it"
    assert got[0].startswith("article 0") and got[30].endswith("words 0")


def test_alignment_infers_optional_and_repeated_groups():
    assert html_wrappers.collapse(["p", "p", "p", "h2"]) == ["p+", "h2"]
    assert html_wrappers.collapse(["dt", "dd", "dt", "dd"]) == ["(dt dd)+"]
    assert html_wrappers.align(["nav", "p+"], ["nav", "div", "p"]) == ["nav", "div?", "p+"]
    assert html_wrappers.align(["a", "b"], ["b", "c"]) == ["a?", "b", "c?"]


# ---------------------------------------------------------------- 7 line dedup

def test_alignment_deletes_from_the_later_document_only(table_of):
    a = [f"line {i} of the first document, which is long enough" for i in range(8)]
    b = ["an own beginning of the second document, long enough", *a[2:6], "", "own end"]
    docs = table_of([(1, "\n".join(a)), (2, "\n".join(b)), (3, "\n".join(a)), (4, "nothing shared"), (5, None), (6, "")])
    out = line_dedup.line_dedup(docs)
    assert out.schema == docs.schema
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text == "\n".join(a) and 3 not in got
    assert got[2].text == "\n".join([b[0], "", "own end"]) and got[2].n_chars == len(got[2].text)
    assert got[4].text == "nothing shared" and got[5].text is None and got[6].text == ""
    assert got[2]["_id"] == 7 and got[2]["cuts"] == 7


def test_patience_alignment():
    a, b = [3, 5, 7, 9, 11], [1, 5, 7, 13, 11]
    assert line_dedup.aligned(a, b) == [(1, 1), (2, 2), (4, 4)]
    for _ in range(200):
        x = [RNG.randint(1, 9) for _ in range(RNG.randint(0, 12))]
        y = [RNG.randint(1, 9) for _ in range(RNG.randint(0, 12))]
        pairs = line_dedup.aligned(x, y)
        assert all(x[i] == y[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
    assert line_dedup.aligned([1, 2, 3], [1, 2, 3]) == [(0, 0), (1, 1), (2, 2)]


def test_frequent_line_alone_deletes_nothing_but_copies_are_found(table_of):
    n = line_dedup.RARE_DOCS + 20
    common = "this line stands in very many documents of the table"
    docs = [(i, f"{common}\nbut document {i} has this own long line beside it") for i in range(n)]
    docs += [(1000 + i, f"{common}\nand this pair of lines is in a group of many copies\nown {i}") for i in range(n)]
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(table_of(docs)).collect()}
    assert all(got[i] == t for i, t in docs[:n])
    assert got[1000] == docs[n][1] and all(got[1000 + i] == f"own {i}" for i in range(1, n))


def test_frequent_passages_and_blocks_of_short_lines_go(table_of):
    n = line_dedup.RARE_DOCS + 20
    passage = " ".join(prose(60, 70))
    short = "\n".join(" ".join(prose(5, 80 + k)) for k in range(6))
    menu = "home\nabout\nterms"
    own = lambda i: f"an own line of document {i} with enough characters"
    docs = [(i, f"{own(i)}\n{passage}\nown end {i}") for i in range(n)]
    docs += [(1000 + i, f"{own(1000 + i)}\n{short}\nown end {i}") for i in range(n)]
    docs += [(2000 + i, f"{own(2000 + i)}\n{menu}\nown tail {i}") for i in range(n)]
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(table_of(docs)).collect()}
    assert got[0] == docs[0][1] and got[1000] == docs[n][1]
    assert all(got[i] == f"{own(i)}\nown end {i}" for i in range(1, n))
    assert all(got[1000 + i] == f"{own(1000 + i)}\nown end {i}" for i in range(1, n))
    assert all(got[i] == t for i, t in docs[2 * n:])


def test_every_deleted_line_stays_in_an_earlier_document(table_of):
    pool = [f"{i} " + "x" * 45 for i in range(25)]
    docs = [(i, "\n".join(random.Random(i).choices(pool, k=6) + [f"own line {i} " + "y" * 40])) for i in range(60)]
    got = {r.doc_id: r.text.split("\n") for r in line_dedup.line_dedup(table_of(docs)).collect()}
    held = set()
    for i, t in docs:
        left = got.get(i, [])
        assert not Counter(left) - Counter(t.split("\n"))
        held |= set(left)
        assert set(t.split("\n")) <= held


def test_line_dedup_on_odd_rows(odd, table_of):
    got = line_dedup.line_dedup(odd)
    texts = Counter(r.text for r in got.collect())
    assert texts[None] == 2 and texts[""] == 1 and got.schema == odd.schema
    assert texts["x"] == 1                                   # the second is a copy of the first as a whole
    assert line_dedup.line_dedup(table_of([])).count() == 0


# ---------------------------------------------------------------- 1 near duplicates

def test_darts_estimate_weighted_jaccard():
    r = np.random.default_rng(1)
    e = r.integers(0, 2 ** 63, 400).astype(np.uint64)
    w1 = r.integers(1, 5, 400).astype(float)
    w2 = np.where(r.random(400) < 0.3, w1 * 0.5, w1)
    s = near_dedup.throw(np.concatenate([e, e]), np.concatenate([w1, w2]), np.repeat([0, 1], 400), 2, k=2000)
    want = np.minimum(w1, w2).sum() / np.maximum(w1, w2).sum()
    assert abs((s[0] == s[1]).mean() - want) < 0.04
    assert (near_dedup.throw(e[:1], w1[:1], np.zeros(1, int), 1) != 0).all()


def brute_classes(docs):
    sets = {i: frozenset(near_dedup.shingles(t).tolist()) for i, t in docs}
    up = {i: i for i, _ in docs}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, _ in docs:
        for j, _ in docs:
            if i < j and sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: root(i) for i, _ in docs}


def test_near_duplicates_against_brute_force(table_of):
    docs = []
    for g in range(12):
        base = prose(120, g)
        for c in range(1 + g % 5):
            words = list(base)
            for _ in range(c * (g % 3)):
                words[random.Random(g * 50 + c).randrange(100)] = f"edit{c}"
            docs.append((len(docs), " ".join(words)))
    chain = prose(200, 77)
    for c in range(8):                                       # each near the next one only
        chain = [*chain[6:], *prose(6, 500 + c)]
        docs.append((len(docs), " ".join(chain)))
    docs += [(len(docs), None), (len(docs) + 1, ""), (len(docs) + 2, "two words"), (len(docs) + 3, "two words")]
    table = table_of(docs).select("doc_id", "text")
    named = {r.doc_id: r for r in near_dedup.classed(near_dedup.keyed(table), near_dedup.copies(table)).select("doc_id", "_class").collect()}
    want = brute_classes(docs)
    for i, t in docs:
        if t:
            assert named[i]["_class"] == want[i]
    kept = near_dedup.near_dedup(table_of(docs))
    assert kept.schema == table_of(docs).schema
    assert {r.doc_id for r in kept.collect()} == {i for i, t in docs if not t or want[i] == i}


def test_unlinked_pairs_hold_all_similar_ones(spark):
    """A large group whose members are about as similar as the threshold, next to texts of other sizes."""
    core = prose(300, 9)
    texts = []
    for i in range(120):
        words = list(core)
        r = random.Random(i)
        for _ in range(r.randrange(3, 9)):                  # each edit changes five shingles
            words[r.randrange(300)] = f"own{i}x{r.random()}"
        texts.append(words[:r.choice([300, 300, 250, 240])])
    sets = [np.unique(near_dedup.shingles(" ".join(t)).view(np.int64)) for t in texts]
    frame = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(sets)], "node long, sh array<long>")
    nodes = spark.createDataFrame([(i, i % 50) for i in range(len(sets))], "node long, comp long")
    want = {(i, j) for i in range(len(sets)) for j in range(i) if i % 50 != j % 50 and near_dedup.similar(sets[i], sets[j])}
    pairs = near_dedup.unlinked_pairs(nodes, frame)
    got = {(r.u, r.v) for r in pairs.collect()}
    assert want and want <= got and len(got) < 0.9 * 120 * 119 / 2
    assert {(r.u, r.v) for r in near_dedup.verified(pairs, frame).collect()} == want


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(101, 100)], "u long, v long")
    got = {r.node: r.comp for r in near_dedup.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_near_dedup_on_odd_rows(odd, table_of):
    kept = near_dedup.near_dedup(odd)
    texts = Counter(r.text for r in kept.collect())
    assert texts[None] == 2 and texts[""] == 1 and texts["x"] == 1 and max(texts.values()) == 2
    assert near_dedup.near_dedup(table_of([])).count() == 0


# ---------------------------------------------------------------- 10 substrings

def test_linear_grouping_orders_suffixes():
    for _ in range(600):
        a = [RNG.randint(0, RNG.choice([1, 2, 5])) for _ in range(RNG.randint(0, 40))] * RNG.choice([1, 1, 3])
        assert suffix_dedup.suffix_order(a) == sorted(range(len(a)), key=lambda i: a[i:])


def brute_cuts(texts):
    seen = Counter(t[i:i + 400] for t in texts for i in range(len(t) - 399))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 399):
            if seen[t[i:i + 400]] > 1:
                gone[i:i + 400] = True
        out.append((len(t), int(gone.sum()), len(suffix_dedup.runs(gone)), hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return out


def substring_docs():
    r = random.Random(8)
    base = " ".join(prose(900, 3))
    docs = [base, base[:2500] + "X" + base[2501:4000], " ".join(prose(60, 9)) + base[700:1150] + " end", "a" * 1500, "a" * 380 + "b" + "a" * 500,
            "abc" * 400, base[100:499], base[100:500], base[100:500] + "!", "é" * 300, "", "short"]
    for i in range(25):                                      # copies with edits here and there
        t = list(base[:3000])
        for _ in range(i % 6):
            t[r.randrange(3000)] = "~"
        docs.append("".join(t))
    return [(i, t) for i, t in enumerate(docs)] + [(900, None), (7, docs[7]), (None, base[300:900])]


@pytest.mark.parametrize("limit", [1 << 20, 2000])
def test_substrings_against_brute_force(table_of, monkeypatch, limit):
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", limit)   # 2000: groups too large for one task
    docs = substring_docs()
    want = Counter(zip([i for i, _ in docs], brute_cuts([(t or "").encode() for _, t in docs]), strict=True))
    rows = suffix_dedup.suffix_dedup(table_of(docs)).collect()
    got = Counter((r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest())) for r in rows)
    assert got == want


def test_substrings_on_odd_rows(odd, table_of):
    assert suffix_dedup.suffix_dedup(odd).count() == odd.count()
    assert suffix_dedup.suffix_dedup(table_of([])).count() == 0


# ---------------------------------------------------------------- all queries on the given tables

def test_registered_names():
    from quarry.llm import registry
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES)
    assert numbers == list(range(1, 14))
    assert defaultdict(int, registry.ORACLE).keys() <= registry.QUERIES.keys()


def test_packed_ids_decode_to_their_bytes():
    from quarry.llm import bpe
    c = bpe.codec(*bpe.default_vocabulary())
    for text in ("", "plain words, 12 numbers", "é́ 日本語 \U0001f600\n\t x", "aaaa" * 300):
        packed = c.encode_packed(text)
        assert c.decode_packed(packed) == text.encode() == c.decode(c.encode(text))


def test_term_weights_some_terms_at_a_time_equal_all_at_once(monkeypatch):
    import numpy as np

    from quarry.llm import toxicity
    rng = np.random.default_rng(3)
    counts = {k: rng.integers(0, 40, 1001).astype(np.int32) for k in (0, 1)}
    whole, sizes = toxicity.term_weights(counts, 900, 700), []
    part = toxicity._part_weights
    monkeypatch.setattr(toxicity, "TERMS", 64)
    monkeypatch.setattr(toxicity, "_part_weights", lambda a, *more: sizes.append(len(a)) or part(a, *more))
    assert (toxicity.term_weights(counts, 900, 700) == whole).all() and max(sizes) == 64 and sum(sizes) == 1000


def test_the_index_is_built_without_sorting_its_postings():
    import tracemalloc
    rng = np.random.default_rng(6)
    n, per, n_terms = 1000, 800, 40_000
    terms = np.concatenate([np.sort(rng.choice(n_terms, per, replace=False)) for _ in range(n)]).astype(np.int32)
    terms[::per], terms[1::per] = 0, 1                  # two common ones
    owner, weights = np.repeat(np.arange(n, dtype=np.int32), per), rng.random(n * per).astype(np.float32)
    some = terms.reshape(n, per)
    keep = np.ones(n * per, bool)
    for i in range(n):                                  # each term is given once in a text
        seen, first = np.unique(some[i], return_index=True)
        keep[i * per:(i + 1) * per] = np.isin(np.arange(per), first)
    owner, terms, weights = owner[keep], terms[keep], weights[keep]
    tracemalloc.start()
    index = toxicity.BlockMaxIndex(n, owner, terms, weights, n_terms)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 30 * len(terms)                       # bytes: 8 of a posting stay
    place = np.empty(n, np.int64)
    place[index.example] = np.arange(n)
    common = index.column[terms] >= 0
    order = np.lexsort((place[owner[~common]], terms[~common]))
    assert (index.places == place[owner[~common]][order]).all() and (index.weights == weights[~common][order]).all()
    assert (index.posting == np.searchsorted(terms[~common][order], np.arange(n_terms + 1))).all()
    for b in range(index.n_blocks):
        want = np.zeros((toxicity.BLOCK, index.n_columns), np.float32)
        here = common & (place[owner] // toxicity.BLOCK == b)
        want[place[owner[here]] % toxicity.BLOCK, index.column[terms[here]]] = weights[here]
        assert (index.block(b) == want).all()


def test_sample_counts_are_read_some_texts_at_a_time(monkeypatch):
    r = random.Random(8)
    rows = []
    for i in range(40):
        held = np.unique(np.array([r.randrange(300) for _ in range(r.randint(0, 30))], np.uint64))
        rows.append((i, 0, held, np.array([r.randint(1, 9) for _ in held], np.int32)))
    monkeypatch.setattr(toxicity, "TEXTS", 7)
    seen, plain = [], np.unique
    monkeypatch.setattr(toxicity.np, "unique", lambda x, **more: seen.append(len(x)) or plain(x, **more))
    known = toxicity.distinct([x[2] for x in rows])
    assert known.tolist() == sorted({int(h) for x in rows for h in x[2]}) and len(seen) == 6
    found = toxicity.counted(rows, toxicity.Vocabulary(known))
    assert found.n == 40 and found.owner.dtype == found.terms.dtype == found.times.dtype == np.int32
    assert found.owner.tolist() == [i for i, x in enumerate(rows) for _ in x[2]]
    assert known[found.terms].tolist() == [h for x in rows for h in x[2].tolist()]
    assert found.times.tolist() == [n for x in rows for n in x[3].tolist()]
    parts = list(found.slices(7))
    assert [p.n for p in parts] == [7] * 5 + [5] and sum((p.times.tolist() for p in parts), []) == found.times.tolist()
    assert (toxicity.tally(found.terms, 400) == np.bincount(found.terms, minlength=400)).all()


def test_the_driver_holds_some_of_the_sample_at_a_time(spark, table_of, monkeypatch):
    docs, labels = toxic_table(spark)
    frame = table_of(docs + docs[:40] + [(12, None), (13, "")])        # rows that repeat an id, and texts without a term
    whole = {(r.doc_id, r.score) for r in toxicity.score(frame.repartition(1), toxicity.fit(frame.repartition(1), labels)).collect()}
    calls, plain = [], toxicity.counted
    monkeypatch.setattr(toxicity, "TEXTS", 16)
    monkeypatch.setattr(toxicity, "counted", lambda rows, known: calls.append(len(rows)) or plain(rows, known))
    monkeypatch.setattr(toxicity.BlockMaxIndex, "nearest", None)       # here only: tasks have processes of their own
    fitted = toxicity.fit(frame.repartition(5), labels)
    assert max(calls) == 16 and sum(calls) == len(fitted.ids) < 450    # examples; no row that calibrates
    rows = toxicity.score(frame, fitted).collect()
    assert len(rows) == len(docs) + 42
    scores = dict(whole)
    assert len(scores) == len(docs) and all(abs(scores[r.doc_id] - r.score) < 1e-6 for r in rows if r.doc_id not in (12, 13))


def test_index_and_terms_are_sent_without_what_follows_from_them():
    import pickle
    rng = np.random.default_rng(9)
    n, per, n_terms = 200, 300, 50_000
    terms = np.concatenate([[0], *[np.append(0, np.sort(rng.choice(np.arange(1, n_terms), per, replace=False))) for _ in range(n)]])[1:]
    owner, weights = np.repeat(np.arange(n), per + 1), rng.random(n * (per + 1)).astype(np.float32)
    index = toxicity.BlockMaxIndex(n, owner, terms.astype(np.int32), weights, n_terms)
    sent = pickle.dumps(index, 5)
    assert len(sent) < 6 * len(index.places) + 4 * n_terms + 10_000     # 6 bytes a posting, and where those of each term start
    again = pickle.loads(sent)
    assert (again.column == index.column).all() and again.n_columns == index.n_columns > 0
    for (a, b), (c, d) in zip(*[x.nearest(n, owner, terms, weights, 5) for x in (index, again)], strict=True):
        assert (a == c).all() and (b == d).all()
    hashes = rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    known = toxicity.Vocabulary(hashes)
    sent = pickle.dumps(known, 5)
    assert len(sent) < 8 * len(known) + 1000
    found = pickle.loads(sent).counts(1, np.zeros(5000, np.int64), hashes)
    assert known.hashes[found.terms].tolist() == sorted(hashes.tolist())


def test_search_keeps_its_batches_whatever_the_number_of_postings(monkeypatch):
    r = random.Random(2)
    vectors = [{0: 0.5, **{t: 0.2 for t in r.sample(range(1, 400), 12)}} for _ in range(300)]
    queries = vectors[:100] + [{}]
    index = toxicity.BlockMaxIndex(300, *rows_of(vectors), 400)
    whole = index.nearest(len(queries), *rows_of(queries), 10)
    monkeypatch.setattr(toxicity, "POSTINGS", 50)       # fewer than those of one query
    calls, search = [], toxicity.BlockMaxIndex._nearest
    monkeypatch.setattr(toxicity.BlockMaxIndex, "_nearest", lambda self, n, *more: calls.append(n) or search(self, n, *more))
    for q, (got, examples), (same, others) in zip(queries, index.nearest(len(queries), *rows_of(queries), 10), whole, strict=True):
        cosines = [sum(q.get(t, 0) * x for t, x in v.items()) for v in vectors]
        assert np.allclose(got, [min(1.0, c) for c in sorted(cosines, reverse=True)[:10] if c > 0], atol=1e-5)
        assert (got == same).all() and (examples == others).all()
    assert calls == [len(queries)]                      # the blocks' matrices are made once for all of them


def test_units_end_where_matches_end_and_are_remembered_once():
    import regex
    path, pattern = bpe.default_vocabulary()
    own = bpe.Codec.load(path, pattern)
    letters = [chr(i) for i in range(0x1bb + 100) if bpe.re.fullmatch(f"[{bpe.LETTER}]", chr(i))]
    assert len(letters) > 300 and all(regex.fullmatch(r"\p{L}", c) for c in letters)
    own.encode(" zqxjk. zqxjk, (zqxjk)")
    assert " zqxjk" in own.units.new and not {" zqxjk.", " zqxjk,"} & own.units.new.keys()
    r, marks = random.Random(4), "ab'sStreé\xd7ßĀƻ \u0301²½Ⅷ19_-.,\"\n\t \x1c\x85\u2028—😀日"
    for _ in range(3000):
        text = "".join(r.choice(marks) for _ in range(r.randint(0, 30)))
        assert own.encode_packed(text) == b"".join(own.merge(m.encode()) for m in own.pattern.findall(text))

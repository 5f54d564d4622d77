"""Decontamination, SimHash, token counts, class LM, classifier and wrappers against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from cellscope.llm import brown, classifier, decontaminate, simhash, tokens, wrappers
from cellscope.llm.graph import components
from cellscope.llm.queries import token_counts

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_overlap(text, items):
    words = WORDS.findall(fold(text))
    hit, found = set(), set()
    for item, body in items:
        own = WORDS.findall(fold(body))
        size = min(len(own), 10)
        for p in range(len(own) - size + 1) if size else ():
            for q in range(len(words) - size + 1):
                if words[q : q + size] == own[p : p + size]:
                    hit |= set(range(q, q + size))
                    found.add(item)
    names = ",".join(sorted(map(str, found)))
    return len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)


def test_overlaps_against_plain_python(spark, documents):
    draw = random.Random(2)
    word = lambda: draw.choice(["Ab", "cd", "é", "Ünd", "x1", "77", "zz"])
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([0, 1, 3, 9, 10, 11, 14, 25, 40])]
    items += [(9, None), (10, items[8][1]), (10, items[8][1]), (11, "unique words only here")]
    texts = [None, "", "...", items[7][1].upper().replace("É", "é").replace("Ü", "Ü")]
    for _ in range(60):
        own = [word() for _ in range(draw.randrange(0, 60))]
        body = draw.choice(items)[1] or ""
        cut = body.split()[draw.randrange(0, 4) :][: draw.randrange(0, 30)]
        at = draw.randrange(0, len(own) + 1)
        texts.append(", ".join(own[:at] + cut + own[at:]))
    docs = documents(*((i, t, "s") for i, t in enumerate(texts)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for chosen in (items, [x for x in items if x[1] and len(x[1].split()) >= 10]):
        some = bench if chosen is items else spark.createDataFrame(chosen, "item_id long, text string")
        for r in decontaminate.overlaps(docs, some).collect():
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == plain_overlap(texts[r.doc_id], chosen)


def test_decontaminate_drops_only_hits(spark, odd_documents):
    bench = spark.createDataFrame([(1, "Same TEXT here!"), (2, None)], "item_id long, text string")
    kept = decontaminate.decontaminate(odd_documents, bench)
    assert kept.columns == odd_documents.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 1), (False, 2), (False, 3), (False, 4), (False, 5), (True, 0), (True, 0)]
    assert decontaminate.overlaps(odd_documents.limit(0), bench).count() == 0
    assert decontaminate.overlaps(odd_documents, bench.limit(0)).filter("contaminated").count() == 0


def plain_fingerprint(text):
    words = fold(text).split(" ") if text else []
    words = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
    if not words:
        return 0
    parts = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, distance=4):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def clustered(n=300, seed=4):
    """Fingerprints in dense clouds, chains and at random."""
    draw, found = random.Random(seed), set()
    while len(found) < n:
        centre = draw.getrandbits(64)
        for _ in range(draw.choice([1, 1, 2, 60])):
            one = centre
            for _ in range(draw.randrange(0, 4)):
                one ^= 1 << draw.randrange(64)
            found.add(one)
            if draw.random() < 0.3:
                centre = one
    return found


@pytest.mark.parametrize("settings", [
    {}, {"limit": 16}, {"segments": 5, "keyed": 2}])
def test_links_give_exactly_the_components(spark, settings):
    nodes = clustered()
    signed = {n - (1 << 64) if n >> 63 else n: n for n in nodes}
    prints = spark.createDataFrame([(n,) for n in signed], "fp long")
    edges = simhash.links(prints, **settings)
    rows = edges.collect()
    assert all((signed[r.a] ^ signed[r.b]).bit_count() <= 4 and r.a != r.b for r in rows)
    groups = {}
    for r in components(edges).collect():
        groups.setdefault(r.root, set()).add(signed[r.node])
    wanted = {}
    for node, root in plain_components(nodes).items():
        wanted.setdefault(root, set()).add(node)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in wanted.values() if len(g) > 1)


def test_too_few_segments_are_refused(spark):
    prints = spark.createDataFrame([(1,)], "fp long")
    with pytest.raises(ValueError):
        simhash.links(prints, segments=2)
    with pytest.raises(ValueError):
        simhash.links(prints, segments=4, keyed=2)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    rows = {r.node: r.root for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert rows == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(200)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_texts(draw, n=40):
    texts = []
    for _ in range(n):
        words = ["w%d" % draw.randrange(10**5) for _ in range(draw.randrange(30, 200))]
        texts.append(" ".join(words))
        if draw.random() < 0.5:
            words[draw.randrange(len(words))] = "other"
            texts.append("\n".join(words).upper())
    return texts


def test_near_duplicates_against_plain_python(documents, odd_documents):
    texts = near_texts(random.Random(8)) + [None, "", " \n", "one two", "ONE\ttwo", "é ü"]
    rows = simhash.near_duplicates(documents(*((i, t, "s") for i, t in enumerate(texts)))).collect()
    prints = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    root, least = plain_components(set(prints.values())), {}
    for i, p in prints.items():
        least[root[p]] = min(i, least.get(root[p], i))
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        i: (f"{p:016x}", least[root[p]]) for i, p in prints.items()}
    odd = simhash.near_duplicates(odd_documents).collect()
    assert len(odd) == 10 and {r.component_id for r in odd if r.doc_id in (1, 2, 3)} == {1}
    assert {r.component_id for r in odd if r.doc_id == 6} == {5}
    assert simhash.near_duplicates(odd_documents.limit(0)).count() == 0


def test_keep_one_of_each_group(documents, odd_documents):
    kept = simhash.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 1), (False, 4), (False, 5), (False, 5), (True, 0), (True, 0)]
    assert simhash.keep_one(odd_documents.limit(0)).count() == 0


def test_fingerprint_of_a_very_long_text():
    text = " ".join("w%d" % (i % 977) for i in range(150_000))
    assert simhash.fingerprint(text) & (1 << 64) - 1 == plain_fingerprint(text)


PATH = public_tokenizers.path("word_bpe_49k.json")


def test_token_counts_are_the_library_s(documents, odd_documents):
    tokenizer = Tokenizer.from_file(PATH)
    texts = [None, "", "  ", "Hello İstanbul ΣΑΣ ας 123 don't", "<|endoftext|>", "a<|startoftext|>B <|endoftext", "café ẛ̣",
             "x y z\x1c\x85q", "日本語 テスト 한국어", "🙂🙃 !!??##", "it's we'RE 'Ll", "İ̇", "\x00a", "‍b̀", "a" * 5000, "ß ŉ ǰ ΐ"]
    texts += ["a" + chr(c) + "B" for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000]
    rows = tokens.count_tokens(documents(*((i, t, "s") for i, t in enumerate(texts))), PATH).collect()
    wanted = tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    bad = [(texts[r.doc_id], r.n_tokens) for r in rows if r.n_tokens != len(wanted[r.doc_id].ids)]
    assert not bad, bad[:5]
    assert all(r.n_bytes == len((texts[r.doc_id] or "").encode()) and r.over_limit == (r.n_tokens > 2048) for r in rows)
    odd = tokens.count_tokens(odd_documents, PATH).collect()
    assert len(odd) == 10 and [r.over_limit for r in odd if r.doc_id == 4] == [True]
    assert tokens.count_tokens(odd_documents.limit(0), PATH).count() == 0


def test_token_query_on_a_table(spark, tmp_path, documents):
    documents((1, "The end", "a"), (None, None, None)).write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted((r.doc_id or 0, r.n_tokens) for r in token_counts(spark, str(tmp_path)).collect()) == [(0, 0), (1, 2)]


def language(draw, n, start=0):
    """Texts whose words alternate between two sets, so that classes tell what follows."""
    return [(start + i, " ".join(("a%d" if k % 2 else "B%d") % draw.randrange(30) for k in range(draw.randrange(1, 50)))) for i in range(n)]


def test_lm_base_is_exact_and_classes_help(documents, odd_documents):
    texts = dict(language(random.Random(6), 300)) | {900: None, 901: "", 902: "unseen wörd ***"}
    rows = {r.doc_id: r for r in brown.score_documents(documents(*((i, t, "s") for i, t in texts.items()))).collect()}
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", fold(t)) + [""]
    apart = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    count = Counter(w for i, t in texts.items() if not apart[i] for w in split(t))
    n, v = sum(count.values()), len(count)
    for i, t in texts.items():
        words, r = split(t), rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (apart[i], len(words), sum(w in count for w in words), n)
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert math.isclose(r.perplexity, 10 ** (-r.score / r.n_tokens), rel_tol=1e-9)
    held = [i for i in texts if apart[i] and texts[i]]
    assert sum(rows[i].score for i in held) > sum(rows[i].base_score for i in held) + 0.1 * sum(rows[i].n_tokens for i in held)
    odd = brown.score_documents(odd_documents).collect()
    assert len(odd) == 10 and all(math.isfinite(r.score) and r.score < 0 for r in odd)
    assert all(r.held_out for r in odd if r.doc_id is None)
    assert brown.score_documents(odd_documents.limit(0)).count() == 0
    alone = brown.score_documents(documents((None, "only held out", "s"))).collect()
    assert alone[0].train_tokens == 0 and alone[0].base_score == 0 and math.isfinite(alone[0].score)


def test_lm_is_a_probability(documents):
    """The probabilities of all one-word texts and of the unknown word add up to at most one."""
    docs = documents(*((i, "a b" if i % 3 else "c", "s") for i in range(50)), *((100 + i, w, "s") for i, w in enumerate("abc")), (200, "", "s"))
    rows = {r.doc_id: r for r in brown.score_documents(docs).collect()}
    assert sum(10 ** rows[i].score for i in (100, 101, 102, 200)) <= 1 + 1e-9


def plain_lm(texts, config):
    """log10 probability of each text; every training word gets its class here, however rare."""
    split = {i: re.findall(r"[^\x20\x09-\x0D]+", fold(t)) + [""] for i, t in texts.items()}
    learn = {i for i in texts if zlib.crc32(str(i).encode()) % 10}
    pairs = Counter(p for i in learn for p in zip([""] + split[i], split[i], strict=False))
    count = Counter(w for i in learn for w in split[i])
    n, end = sum(count.values()), config.classes + brown.SHAPES
    k = end + 1
    seeds = sorted((w for w in count if w), key=lambda w: (-count[w], w))[: config.classed]
    of = {w: config.classes + brown.shape(w) for w in count} | {w: i % config.classes for i, w in enumerate(seeds)}

    def table(of):
        cells = [[0] * k for _ in range(k)]
        for (a, b), often in pairs.items():
            cells[of[a]][of[b]] += often
        return cells, [sum(r) for r in cells], [sum(c) for c in zip(*cells, strict=True)]

    def likelihood(of):
        cells, rows, cols = table(of)
        h = lambda x: x * math.log(x) if x else 0.0
        return sum(h(x) for r in cells for x in r) - sum(map(h, rows)) - sum(map(h, cols))

    for turn in range(2 * config.rounds):
        moves = {}
        for w in seeds[turn % 2 :: 2]:
            gain = [likelihood(of | {w: c}) for c in range(config.classes)]
            best = max(range(config.classes), key=gain.__getitem__)
            if gain[best] > gain[of[w]] + 1e-9:
                moves[w] = best
        of |= moves
        if not moves and turn % 2:
            break
    cells, rows, cols = table(of)
    prior = config.prior
    after = lambda c, r: (cells[c][r] + prior * (cols[r] + 1) / (n + k)) / (rows[c] + prior)
    before = lambda x, c: (cells[x][c] + prior * (rows[x] + 1) / (n + k)) / (cols[c] + prior)
    moves = {}
    for w in count.keys() - {"", *seeds}:
        gain = []
        for c in range(end):
            fit = 0.0
            for (a, b), often in pairs.items():
                if a == b == w:
                    fit += often * math.log(after(c, c) / (cols[c] + prior))
                elif a == w:
                    fit += often * math.log(after(c, of[b]))
                elif b == w:
                    fit += often * math.log(before(of[a], c))
            gain.append(round(fit, 6))
        moves[w] = gain.index(max(gain))
    of |= moves
    cells, rows, cols = table(of)
    once = {w for w in count if w and count[w] == 1}
    cut = len(once) / max(len(once) + 2 * sum(count[w] == 2 for w in count if w), 1)
    kept = [cols[c] - cut * sum(of[w] == c for w in count if w) for c in range(k)]
    seen = Counter()
    for (a, b), often in pairs.items():
        for x in (of[a], *([("?", brown.shape(a))] if a in once else [])):
            for y in (of[b], *([("?", brown.shape(b))] if b in once else [])):
                seen[x, y] += often
    shapes = [("?", s) for s in range(brown.SHAPES)]
    alone = {s: (sum(seen[c, s] for c in range(k)) + 0.5) / (n + brown.SHAPES) for s in shapes}

    def chance(x, y):
        total = sum(seen[x, c] for c in range(k)) + prior
        new = {s: (seen[x, s] + prior * alone[s]) / total for s in shapes}
        if y in new:
            return new[y]
        known = [(seen[x, c] + prior * (cols[c] + 1) / (n + k)) * (kept[c] / cols[c] if cols[c] else 1) for c in range(k)]
        return known[y] / sum(known) * (1 - sum(new.values()))

    scores = {}
    for i, words in split.items():
        scores[i], x = 0.0, end
        for w in words:
            y = of.get(w, ("?", brown.shape(w)))
            word = (count[w] - (cut if w else 0)) / kept[y] if w in count else 1.0
            base = (count[w] + 0.1) / (n + 0.1 * (len(count) + 1))
            scores[i] += math.log10(config.mix * chance(x, y) * word + (1 - config.mix) * base)
            x = y
    return scores


def test_lm_scores_are_those_of_a_plain_model_that_classes_every_word(spark, documents, monkeypatch):
    draw = random.Random(8)
    rare = lambda: draw.choice(["w%d", "%d", "long-word-%d", "é%d", "w%d."]) % int(40 ** draw.random() ** 0.5)
    texts = {i: t + " " + " ".join(rare() for _ in range(draw.randrange(6))) for i, t in language(draw, 40)}
    texts |= {50: "w1 w1 w1 x x", 51: "x x a1", 52: None, 53: "", 54: "new9 w1 NEW. new"}
    config = brown.BrownConfig(classed=6, classes=3, rounds=2)
    wanted = plain_lm(texts, config)
    assert len({w for t in texts.values() for w in (t or "").split()}) > 10 * config.classed
    monkeypatch.setattr(brown, "CHUNK_WORDS", 40)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # a word's rows are cut by batches
    try:
        rows = brown.score_documents(documents(*((i, t, "s") for i, t in texts.items())), config).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert len(rows) == len(texts)
    assert not [(r.doc_id, r.score, wanted[r.doc_id]) for r in rows if not math.isclose(r.score, wanted[r.doc_id], rel_tol=1e-9)]


def test_lm_words_seldom_seen_follow_their_contexts(documents):
    """Words beyond the most frequent ones are told apart by what stands around them, not by their shape."""
    draw = random.Random(9)
    texts = [(i, " ".join(("k%03d" if p % 2 else "m%03d") % draw.randrange(400) for p in range(30))) for i in range(400)]
    rows = brown.score_documents(documents(*((i, t, "s") for i, t in texts)), brown.BrownConfig(classed=40, classes=4)).collect()
    held = [r for r in rows if r.held_out]
    # half of the words can follow at each place; what words have in common by shape tells nothing of it
    assert sum(r.score - r.base_score for r in held) > 0.15 * sum(r.n_tokens for r in held)


def test_classifier_learns_and_ignores_held_out_labels(documents, labels, odd_documents):
    draw = random.Random(1)
    text = lambda bad: " ".join("w%d" % draw.randrange(200) + ("***" if bad and draw.random() < 0.6 else "") for _ in range(40))
    rows = [(i, text(i % 4 == 0), "s") for i in range(400)] + [(5000, None, None), (None, "", "x")]
    marks = [(i, 0 if i % 4 == 0 else 1, 0) for i in range(400)]
    docs = documents(*rows)
    got = {r.doc_id: r for r in classifier.score_quality(docs, labels(*marks)).collect()}
    assert len(got) == 402 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    apart = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i].held_out == (i in set(apart)) for i in range(400))
    assert sum(got[i].predicted == (i % 4 != 0) for i in apart) >= 0.95 * len(apart)
    turned = [(i, 1 - q if i in set(apart) else q, t) for i, q, t in marks]
    again = {r.doc_id: r.score for r in classifier.score_quality(docs, labels(*turned)).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_word_vectors_against_plain_python(documents):
    """All documents count, labelled or not; nothing is shared between texts; long texts are whole."""
    config = classifier.ClassifierConfig(buckets=64, dims=8)
    draw = random.Random(4)
    texts = [" ".join(draw.choice("abcdefghij") + draw.choice(["", "1", "!"]) for _ in range(n)) for n in (0, 1, 2, 3, 7, 40)]
    texts += [None, " ".join("w%s" % "abcde"[i * i % 5] for i in range(classifier.BLOCK + 500))]
    index, known = classifier.index_vectors(config), classifier._Buckets(config.buckets)
    wanted = [[0.0] * 8 for _ in range(64)]
    for text in texts:
        ids = classifier.token_buckets(text, known).tolist()
        for i, bucket in enumerate(ids):
            for j in range(max(0, i - 2), min(len(ids), i + 3)):
                if j != i:
                    wanted[bucket] = [x + float(y) for x, y in zip(wanted[bucket], index[ids[j]], strict=True)]
    got = classifier.word_vectors(documents(*((i, t, "s") for i, t in enumerate(texts))).repartition(3), config)
    for row, plain in zip(got.tolist(), wanted, strict=True):
        length = sum(x * x for x in plain) ** 0.5
        assert all(abs(x - y / max(length, 1e-9)) < 1e-6 for x, y in zip(row, plain, strict=True))


def test_classifier_without_labels(odd_documents, labels):
    rows = classifier.score_quality(odd_documents, labels()).collect()
    assert len(rows) == 10 and {r.score for r in rows} == {0.5}
    only = classifier.score_quality(odd_documents, labels((2, 1, 0), (6, 1, 0), (4, None, 0))).collect()
    assert len({round(r.score, 9) for r in only}) == 1
    assert classifier.score_quality(odd_documents.limit(0), labels((1, 1, 0))).count() == 0


HEAD = "<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a='<p>';</script></head><body>"
NAV = "<nav><ul><li><a href='/'>home</a></li><li><a href='/b'>b</a></li></ul></nav>"


def test_wrappers_take_the_article(spark):
    pages = []
    for i in range(30):
        body = "".join(f"<p>para {i} {k} &amp; caf&eacute; <b>bold</b>\n more</p>" for k in range(i % 4 + 1))
        extra = "<div class='cookie-notice'>we use cookies</div>" if i % 2 else ""
        comments = "<section id='comments'><p>first!</p></section>" if i % 3 else ""
        pages.append((i, f"http://h{i % 2}.org/{i}", f"{HEAD}{NAV}{extra}<div class='ad'>buy</div><article><h1>Title {i}</h1>{body}"
                      f"{comments}<form><input><label>mail</label></form></article><aside>side</aside><footer>foot</footer></body></html>"))
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    for r in wrappers.extract_text(frame).collect():
        wanted = [f"Title {r.page_id}"] + [f"para {r.page_id} {k} & café bold more" for k in range(r.page_id % 4 + 1)]
        assert r.text == "\n\n".join(wanted) and r.n_chars == len(r.text)


def test_wrappers_without_an_article_element(spark):
    pages = [(i, "https://plain.example/%d" % i,
              f"{HEAD}<div><a href='/'>home</a> <a href='/x'>x</a></div><div><div>constant line</div>"
              f"<div><h1>Heading {i}</h1>" + "".join(f"<p>story {i} part {k} with some more words</p>" for k in range(i % 3 + 2)) +
              "</div></div><div>all rights reserved</div></body></html>") for i in range(12)]
    rows = wrappers.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    for r in rows:
        assert r.text.split("\n\n") == [f"Heading {r.page_id}"] + [
            f"story {r.page_id} part {k} with some more words" for k in range(r.page_id % 3 + 2)]


def test_pages_without_an_article_beside_pages_with_one(spark):
    plain = lambda i: f"{HEAD}{NAV}<div><h1>Heading {i}</h1><p>story {i} with some words of its own</p></div><div>all rights reserved</div></body></html>"
    article = lambda i: f"{HEAD}{NAV}<article><p>text {i}</p></article></body></html>"
    pages = [(i, ("http://both.org/%d" % i) if i < 20 else None, article(i) if i % 5 == 0 else plain(i)) for i in range(40)]
    for r in wrappers.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect():
        i = r.page_id
        assert r.text == (f"text {i}" if i % 5 == 0 else f"Heading {i}\n\nstory {i} with some words of its own")


def test_names_do_not_remove_the_article(spark):
    names = ["table-responsive", "entry-header", "has-sidebar", "no-sidebar", "elementor-widget-container", "search-result",
             "football", "advice", "commentary", "comments"]
    pages, wanted = [], {}
    for k, name in enumerate(names):
        for i in range(4):
            body = f"<p>first part of the story {i} of {name}</p><figure><img src=x><figcaption>picture {i}</figcaption></figure>"
            share = f"<div class='share'><a href=x>share {i}</a></div>"
            inside = f"{HEAD}{NAV}<article><div class='{name}'>{body}</div>{share}</article></body>"
            around = f"{HEAD}{NAV}<div class='{name}'><article>{body}</article></div></body>"
            for at, html in enumerate((inside, around)):
                pages.append((100 * k + 10 * at + i, f"http://{name}{at}.org/{i}", html))
                wanted[pages[-1][0]] = f"first part of the story {i} of {name}\n\npicture {i}"
    rows = wrappers.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in rows} == wanted


def test_a_shared_beginning_is_not_a_constant_text(spark):
    same = ("the same first paragraph of every page, " * 10).strip()
    pages = [(i, "http://same.org/", f"{HEAD}<div><p>{same}</p><p>then story {i}</p></div></body>") for i in range(10)]
    for r in wrappers.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect():
        assert r.text == f"{same}\n\nthen story {r.page_id}"


def test_ids_of_pages_do_not_hide_constant_text(spark):
    pages = [(i, "http://ids.org/", f"{HEAD}<div id=top-{i} class='bar{i}'>all rights reserved and a line that is on every page of the host</div>"
              f"<div id='post-{i}' class='post tag-{chr(97 + i)}'><p>story {i}</p></div></body>") for i in range(20)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in wrappers.extract_text(frame).collect()} == {i: f"story {i}" for i in range(20)}
    content = wrappers.infer_wrappers(frame.selectExpr("'ids.org' AS host", "html")).collect()
    assert [c.fallback for c in content] == [["html > body > div post > p"]]


def test_fold_and_align():
    html = lambda n, extra="": "<body><ul>" + "<li>x</li>" * n + "</ul>" + extra + "<article><p>a</p></article></body>"
    many, one = wrappers.expression(html(5)), wrappers.expression(html(1, "<div>note</div>"))
    assert many == wrappers.expression(html(3)) == [["e", "body", [
        ["e", "ul", [["+", [["e", "li", ["#"]]]]]], ["e", "article", [["e", "p", ["#"]]]]]]]
    both = wrappers.align(many, one)
    assert both == [["e", "body", [
        ["e", "ul", [["+", [["e", "li", ["#"]]]]]], ["?", [["e", "div", ["#"]]]], ["e", "article", [["e", "p", ["#"]]]]]]]
    assert wrappers.align(both, many) == wrappers.align(many, both) == both
    assert wrappers.slot_paths(both) == [("body", "ul", "li"), ("body", "div"), ("body", "article", "p")]
    pairs = wrappers.expression("<dl>" + "<dt>a<dd>b" * 4 + "</dl>")
    assert pairs == [["e", "dl", [["+", [["e", "dt", ["#"]], ["e", "dd", ["#"]]]]]]]


def test_wrappers_edge_cases(spark):
    rows = [(1, None, None), (2, "http://a.b/", ""), (3, "notaurl", "<article><p>un<i>closed"), (3, "notaurl", "<article><p>un<i>closed"),
            (None, "http://a.b/", "<article>" + "<p>word &lt;b&gt; </p>" * 3000), (4, "http://a.b/", "text only < 3 & more")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = wrappers.extract_text(frame).collect()
    assert len(got) == 6
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r.text)
    assert by[1] == [""] and by[2] == [""] and by[3] == ["unclosed"] * 2
    assert by[None] == ["\n\n".join(["word <b>"] * 3000)]
    assert wrappers.extract_text(frame.limit(0)).count() == 0


def test_many_templates_of_one_host_are_merged_in_bounded_groups(spark):
    pages = [(i, "http://one.org/", "<body>" + "".join(f"<div class='c{(i >> b) & 1}x{b}'>z{i}</div>" for b in range(6))
              + f"<article><p>text {i}</p></article></body>") for i in range(64)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'one.org' AS host")
    content = wrappers.infer_wrappers(frame.select("host", "html"), group=8).collect()
    assert len(content) == 1 and content[0].content == ["body > article > p"]


def test_pages_without_end(spark):
    text = " ".join("word%d" % i for i in range(40))
    deep = {
        1: "<body>" + "<div>" * 1500 + f"<p>{text}</p>",
        2: "<article>" + "<div>" * 100_000 + text,
        3: "<body>" + "".join(f"<div>x{i}" for i in range(3000)),
        4: "<body><article>" + "".join(f"<section id='s'><p>{i}</p></section>" for i in range(300)) + "</article>",
        5: "<body><article>" + "<div>" * 400 + f"<p>{text}</p>" + "</div>" * 400 + "<p>after</p></article>"}
    pages = spark.createDataFrame([(i, "http://deep.example/%d" % i, html) for i, html in deep.items()], "page_id long, url string, html string")
    found = {row.page_id: row.text for row in wrappers.extract_text(pages).collect()}
    assert all(text in found[i] for i in (1, 2, 5)) and "x2999" in found[3] and "299" in found[4]
    assert "after" in found[5]


def test_many_different_siblings_are_aligned():
    one = [["e", f"p a{i}", []] for i in range(20_000)]
    other = [["e", f"p a{i}", []] for i in range(1, 20_001)]
    merged = wrappers.align(one, other)
    kinds = [item[0] for item in merged]
    assert kinds.count("e") >= 19_000 and len(merged) <= 21_100
    assert wrappers.align(one[:50], other[:50])[0] == ["?", [one[0]]]

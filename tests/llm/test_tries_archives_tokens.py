"""Prefix tries, packaged archives and tokenizer alignment against plain Python."""

import base64
import hashlib
import io
import json
import random
import re
import struct
import zipfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellscope.llm import alignment, prefixtrie, warczip

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH_A, PATH_B = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


# --- prefix trie ------------------------------------------------------------------


def plain_trie(rows, rebuild):
    turns = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns[c].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [pair for _, pair in sorted(turns[c])] for c in turns}
    if rebuild:
        base = lambda c: c - (abs(c) % 20) * (1 if c >= 0 else -1)
        h = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
        own = {c: own.get(base(c), [])[: h[c]] + own[c][h[c] :] for c in own}
    members, children, out = defaultdict(list), defaultdict(list), {}
    for c, pairs in own.items():
        for d in range(len(pairs) + 1):
            members[tuple(pairs[:d])].append(c)
    for key in members:
        if key:
            children[key[:-1]].append(key)
    for key in sorted(members, key=len, reverse=True):
        ids = members[key]
        ends = ",".join(map(str, sorted(c for c in ids if len(own[c]) == len(key))))
        saved = (len(ids) - 1) * (len(WORD.findall(key[-1][1])) if key else 0) + sum(out[x][6] for x in children[key])
        out[key] = (min(ids), len(key), min(members[key[:-1]]) if key else None, len(ids), len(children[key]),
                    sum(out[x][5] for x in children[key]) if children[key] else 1, saved, hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=lambda x: x[:2])


def talk(spark, rows):
    return spark.createDataFrame(
        [(*row, "h", 1, "k") for row in rows], "conv_id long, turn long, role string, text string, h1 string, i int, c string")


def same_trie(spark, rows, rebuild=False, **sketch):
    arrange = prefixtrie.branched if rebuild else prefixtrie.plain
    got = prefixtrie.prefix_trie(talk(spark, rows), arrange, **sketch).collect()
    assert sorted(map(tuple, got), key=lambda x: x[:2]) == plain_trie(rows, rebuild)
    return got


@pytest.fixture(scope="module")
def talks():
    draw = random.Random(5)
    rows = []
    for c in [*range(0, 90), -3, -20, -41]:
        for turn in range(draw.randrange(0, 7)):
            rows.append((c, turn, draw.choice(["user", "bot", None]), draw.choice(["hi there", "a  b\tc", None, "x"])))
    return rows + [(7, None, "user", "hi there"), (8, 1, "user", "same"), (8, 1, "user", "same"), (None, 0, "user", "lost")]


@pytest.mark.parametrize("rebuild", [False, True])
def test_trie_against_plain_python(spark, talks, rebuild):
    same_trie(spark, talks, rebuild)


def test_trie_does_not_depend_on_the_sketch(spark, talks):
    # one row of few cells proves next to nothing: all prefixes are grouped exactly
    same_trie(spark, talks, True, sketch_rows=1, cells=prefixtrie.BLOCK)
    rows = prefixtrie.prefixes(*prefixtrie.plain(prefixtrie.numbered_turns(talk(spark, talks))))
    proven = prefixtrie.screened(rows).filter("single").select("i", "h1", "h2", "c")
    often = rows.groupBy("i", "h1", "h2").agg(F.count("*").alias("n"))
    assert proven.join(often, ["i", "h1", "h2"]).filter("n > 1").count() == 0 and proven.count() > 0


def test_trie_of_odd_tables(spark):
    assert same_trie(spark, []) == []
    assert len(same_trie(spark, [(None, 1, "a", "b")])) == 0
    assert len(same_trie(spark, [(1, None, None, None), (1, None, None, None)])) == 3
    # conversation 21 is rebuilt from nothing and has fewer turns than it gives up
    assert [row.n_convs for row in same_trie(spark, [(22, 0, "a", "b")], rebuild=True)] in ([1], [1, 1])


def test_trie_of_very_long_and_hot_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "RANGE", 8)
    monkeypatch.setattr(prefixtrie, "IDS", 16)
    long = [(1, t, "u", "w %d" % t) for t in range(60)] + [(2, t, "u", "w %d" % t) for t in range(50)]
    many = [(c, t, "u", "same") for c in range(100, 220) for t in range(3)]
    same_trie(spark, long + many + [(9, 0, "u", "word " * 50_000)])


# --- packages ---------------------------------------------------------------------


def pages(spark, rows):
    return spark.createDataFrame(
        [(*row, "x", "y") for row in rows], "page_id long, url string, html string, payload string, hash string")


ODD_PAGES = [
    (3, "http://a.example/x?q=1", "<p>eins</p>"), (1, "http://b.example/", "<p>eins</p>"), (2, None, None), (4, "", ""),
    (5, "http://c.example/ä b\r\nX-Page: [1]", "é" * 1000), (6, "http://[bad", "<p>zwei</p>\r\n\r\nWARC/1.1"),
    (None, "http://d.example/", "<p>eins</p>"), (None, None, "nobody"), (7, "%41", "z" * 3_000_000), (1, "http://b.example/", "<p>eins</p>"),
    (8, "http://e.example/", "\x00\x1f")]


def plain_records(rows, least=0):
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    found = []
    for page, url, html in rows:
        data, at = (html or "").encode(), first.get(html or "")
        again = at is not None and at != page and len(data) >= least
        found.append((page, url, "revisit" if again else "response", at if again else None, len(data),
                      base64.b32encode(hashlib.sha1(data).digest()).decode(), None if again else data))
    return sorted(found, key=str)


def read_rows(records):
    columns = ("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload")
    number = lambda x: None if x is None else int(x)
    rows = [[row[name] for name in columns] for row in records.collect()]
    return sorted(((number(r[0]), r[1], r[2], number(r[3]), r[4], r[5], None if r[6] is None else bytes(r[6])) for r in rows), key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_packages_round_trip(spark, least):
    packages = warczip.write_packages(pages(spark, ODD_PAGES).repartition(3), min_bytes=least, max_records=2)
    assert packages.count() >= 5 and packages.agg(F.sum("records")).first()[0] == len(ODD_PAGES)
    assert read_rows(warczip.read_packages(packages)) == plain_records(ODD_PAGES, least)


def test_packages_of_no_pages(spark):
    packages = warczip.write_packages(pages(spark, []))
    assert packages.count() == 0 and warczip.read_packages(packages).count() == 0


def test_hot_payload_and_small_ranges(spark):
    rows = [(i, "http://h.example/%d" % i, "copy" if i % 3 else "own %d" % i) for i in range(300)]
    packages = warczip.write_packages(pages(spark, rows).repartition(4))
    ranges = warczip.record_ranges(packages, range_bytes=4000)
    assert ranges.count() > 20 and ranges.agg(F.sum(F.size("offsets"))).first()[0] == 300
    assert max(row["size"] for row in ranges.collect()) <= 4000
    assert read_rows(warczip.read_packages(packages, task_bytes=10_000)) == plain_records(rows)


def test_the_standard_library_reads_our_packages(spark):
    path = warczip.write_packages(pages(spark, ODD_PAGES).coalesce(1)).first().path.removeprefix("file:")
    with zipfile.ZipFile(path) as package:
        assert package.testzip() is None and package.namelist() == [warczip.ARCHIVE, warczip.INDEX]
        records = zlib.decompressobj(31)
        assert records.decompress(package.read(warczip.ARCHIVE)).startswith(b"WARC/1.1\r\nWARC-Type: re")
        lines = zlib.decompress(package.read(warczip.INDEX), 31).decode().splitlines()
    assert len(lines) == len(ODD_PAGES) and lines == sorted(lines)


def directory_of(data):
    file = io.BytesIO(data)
    return [(name, method, size) for name, method, _, size, _ in warczip.members(file, len(data))], file


@pytest.mark.parametrize("comment", [b"", b"PK\5\6" + bytes(30), b"x" * 0xFFFF])
def test_directories_with_comments(comment):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as package:
        for i in range(3):
            package.writestr(f"archive/ä{i}.warc", b"x" * i, zipfile.ZIP_STORED if i else zipfile.ZIP_DEFLATED)
        package.comment = comment
    got, file = directory_of(buffer.getvalue())
    assert got == [("archive/ä0.warc", 8, 0), ("archive/ä1.warc", 0, 1), ("archive/ä2.warc", 0, 2)]
    starts = [warczip.data_start(file, header) for *_, header in warczip.members(file, len(buffer.getvalue()))]
    assert buffer.getvalue()[starts[2] : starts[2] + 2] == b"xx"


def test_zip64_directories():
    many = io.BytesIO()
    with zipfile.ZipFile(many, "w") as package:
        for i in range(0x10005):  # more entries than the old field holds
            package.writestr(f"f{i}", b"")
    got, _ = directory_of(many.getvalue())
    assert len(got) == 0x10005 and got[-1][0] == f"f{0x10005 - 1}"
    # a directory whose member says that its sizes and place are in the extra field
    name, body = b"archive/big.warc", b"content"
    local = struct.pack("<4s5H3L2H", b"PK\3\4", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20) + name
    local += struct.pack("<HHQQ", 1, 16, len(body), len(body)) + body
    pad = b"\0" * 100
    extra = struct.pack("<HHL", 0x7777, 4, 9) + struct.pack("<HHQQQ", 1, 24, len(body), len(body), len(pad))
    entry = struct.pack("<4s6H3L5H2L", b"PK\1\2", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF)
    at = len(pad) + len(local)
    end = struct.pack("<4sQ2H2L4Q", b"PK\6\6", 44, 45, 45, 0, 0, 1, 1, len(entry + name + extra), at)
    where = struct.pack("<4sLQL", b"PK\6\7", 0, at + len(entry + name + extra), 1)
    last = struct.pack("<4s4H2LH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    data = pad + local + entry + name + extra + end + where + last
    got, file = directory_of(data)
    assert got == [("archive/big.warc", 0, 7)]
    (*_, packed, _, header), = warczip.members(file, len(data))
    start = warczip.data_start(file, header)
    assert data[start : start + packed] == body


def test_foreign_and_broken_packages(spark, tmp_path):
    record, _ = warczip.make_record("5", "http://x.example/", b"hello", None, "2000-01-01T00:00:00Z")
    packed = zlib.compressobj(9, zlib.DEFLATED, 31)
    data = packed.compress(record) + packed.flush()
    line = lambda **more: "com,example)/ 2000 " + json.dumps({"offset": "0", "length": str(len(data)), "filename": "a.warc.gz"} | more)

    def package(name, method=zipfile.ZIP_STORED, body=data, **more):
        with zipfile.ZipFile(tmp_path / name, "w") as out:
            out.writestr("datapackage.json", "{}")
            out.writestr("indexes/index.cdxj", line(**more), zipfile.ZIP_DEFLATED)
            out.writestr("archive/a.warc.gz", body, method)
        return spark.createDataFrame([(str(tmp_path / name), 1)], "path string, bytes long")

    row, = warczip.read_packages(package("good.wacz")).collect()
    assert (row.page_id, bytes(row.payload), row.record_type) == ("5", b"hello", "response")
    bad = record.replace(b"hello", b"jello")
    packed = zlib.compressobj(9, zlib.DEFLATED, 31)
    changed = packed.compress(bad) + packed.flush()
    for name, options, message in (
            ("deflated.wacz", {"method": zipfile.ZIP_DEFLATED}, "only stored"), ("beyond.wacz", {"length": "9999"}, "ends beyond"),
            ("changed.wacz", {"body": changed, "length": len(changed)}, "differs from its length or digest")):
        with pytest.raises(Exception, match=message):
            warczip.read_packages(package(name, **options)).collect()
    (tmp_path / "cut.wacz").write_bytes((tmp_path / "good.wacz").read_bytes()[:-30])
    with pytest.raises(Exception, match="no end of a ZIP directory"):
        warczip.read_packages(spark.createDataFrame([(str(tmp_path / "cut.wacz"), 1)], "path string, bytes long")).collect()


# --- tokenizer alignment ----------------------------------------------------------


def plain_alignment(rows):
    a, b = Tokenizer.from_file(PATH_A), sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    a.encode_special_tokens = True
    letters = alignment._byte_letters()
    found, often = [], Counter()
    for _, text in rows:
        whole = f" {text or ''}".encode()
        one, two = a.encode(f" {text or ''}", add_special_tokens=False), b.encode(text or "")
        sides = [[(i, bytes(letters[x] for x in t)) for i, t in zip(one.ids, one.tokens)],
                 [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in two]]
        if not text or any(b"".join(x for _, x in side) != whole for side in sides):
            found.append(None)
            continue
        ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in sides]
        groups, at = [], [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            group = []
            for s in (0, 1):
                stop = ends[s].index(end) + 1
                group.append([i for i, _ in sides[s][at[s] : stop]])
                at[s] = stop
            groups.append(group)
        links = Counter((x, y) for xs, ys in groups for x in xs for y in ys)
        often.update(links.keys())
        found.append((groups, links))
    best = defaultdict(int)
    for (x, _), n in often.items():
        best[x] = max(best[x], n)
    out = []
    for (doc_id, _), own in zip(rows, found):
        if own is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        groups, links = own
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        out.append((doc_id, sum(len(xs) for xs, _ in groups), sum(len(ys) for _, ys in groups), len(groups), sum(links.values()),
                    sum(m for pair, m in links.items() if often[pair] == best[pair[0]]),
                    sum(m * often[pair] for pair, m in links.items()), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def odd_texts():
    draw = random.Random(11)
    words = ["the", "Haus", "naïve", "東京", "<|endoftext|>", "<s>", "12345", "don't", "ünï", "🙂🙃", "a\u0301", "\u200b", "Ω", "ßtraße", "::=>"]
    gaps = [" ", "  ", "\n", "\t", "\r\n", "\u00a0", "\u0085", "\x1c", " \n ", "\u3000"]
    texts = ["".join(draw.choice(words) + draw.choice(gaps) for _ in range(draw.randrange(1, 60))) for _ in range(60)]
    return [None, "", " ", "  x", "x  ", "\x00", "▁a ▁", "<0x41>", *texts, texts[5], "tail", "a" * 5000, "ab" * 3000]


def test_alignment_against_plain_python(spark, documents):
    rows = [(None if i == 20 else i % 50, text) for i, text in enumerate(odd_texts())]
    docs = documents(*((i, t, "s") for i, t in rows)).repartition(3)
    got = alignment.align_tokenizers(docs, PATH_A, PATH_B, radixes=7, chunk_tokens=500)
    assert sorted(map(tuple, got.collect()), key=str) == plain_alignment(rows)
    assert alignment.align_tokenizers(docs.limit(0), PATH_A, PATH_B).count() == 0


def test_long_texts_are_cut_where_both_sides_cut(monkeypatch):
    monkeypatch.setattr(alignment.pieces_of, "__defaults__", (40,))
    texts = [t for t in odd_texts() if t] + ["lorem ipsum, dolor  sit \n amet " * 50]
    cut = alignment.encoded(texts, PATH_A, PATH_B)
    assert any(len(alignment.pieces_of(t)) > 3 for t in texts)
    monkeypatch.setattr(alignment.pieces_of, "__defaults__", (10**9,))
    for whole, pieces in zip(alignment.encoded(texts, PATH_A, PATH_B), cut):
        assert all(np.array_equal(x, y) for x, y in zip(whole, pieces))


def test_quick_encoding_equals_the_library():
    side, library = alignment.Bytewise(PATH_A), Tokenizer.from_file(PATH_A)
    library.encode_special_tokens = True
    draw = random.Random(3)
    texts = odd_texts()[2:] + ["".join(chr(draw.randrange(32, 0x2FF)) for _ in range(200)) for _ in range(200)]
    assert side.quick is not None
    for text, ids in zip(texts, side.encode(texts)):
        assert list(ids) == library.encode(f" {text}", add_special_tokens=False).ids


def test_large_groups_are_counted_by_their_ids(monkeypatch):
    draw = np.random.default_rng(4)
    a, b = draw.integers(0, 9, 500), draw.integers(0, 6, 400)
    of_a, of_b = np.sort(draw.integers(0, 5, 500)), np.sort(draw.integers(0, 5, 400))
    plain = Counter(int(x) * 10 + int(y) for x, g in zip(a, of_a) for y, k in zip(b, of_b) if g == k)
    for limit in (1, 100, 10**9):
        monkeypatch.setattr(alignment, "LARGE_GROUP", limit)
        codes, links, total = alignment.linked(a, b, of_a, of_b, 5, 10)
        assert dict(zip(codes.tolist(), links.tolist())) == plain and total == sum(plain.values())


def test_merge_of_runs():
    draw = random.Random(6)
    runs, often = [], Counter()
    for _ in range(9):
        own = Counter(draw.randrange(0, 400) for _ in range(draw.randrange(0, 90)))
        often.update(own)
        codes = sorted(own)
        runs.append((np.array(codes, np.int64), np.array([own[c] for c in codes], np.int64)))
    best = {a: max(n for c, n in often.items() if c // 20 == a) for a in {c // 20 for c in often}}
    packed = [alignment._from_run(alignment._run(*run)) if len(run[0]) else run for run in runs]
    for (codes, _), back in zip(runs, alignment.merged(packed, 20)):
        assert back.tolist() == [2 * often[c] + (often[c] == best[c // 20]) for c in codes.tolist()]


def test_numbers_are_packed_whole():
    for values in ([], [0], [255, 256, 0], [2**40, 1]):
        assert alignment.stretch(alignment.squeeze(np.array(values, np.int64))).tolist() == values
    rising, lengths = np.array([3, 9, 0, 5, 7, 2]), np.array([2, 0, 3, 1])
    steps = alignment.differences(rising, np.array([0, 2, 5]))
    assert alignment.from_differences(steps, lengths).tolist() == rising.tolist()

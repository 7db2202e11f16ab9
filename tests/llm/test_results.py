"""Each operator against a brute-force version on small documents."""

import base64
import collections
import datetime
import hashlib
import itertools
import random
import re
import time
import zlib
from itertools import combinations

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tapewright.llm import decontamination, minhash_dedup, passage_dedup, suffix_dedup
from tapewright.llm.line_dedup import dedup_lines
from tapewright.llm.piece_codec import encode_decode
from tapewright.llm.pseudonyms import Feistel, luhn_digit, pseudonymize
from tapewright.llm.quality_rules import clean_lines
from tapewright.llm.sharding import kd_shards
from tapewright.llm.warc import read_records, write_archives

SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_line_dedup(docs, corpus):
    holders = collections.defaultdict(set)
    key = lambda line: line.strip(SPACES).translate(LOWER)
    for i, t in corpus:
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)
    for bits in (27, 10):  # a filter that is full only suspects more
        got = {r.doc_id: r for r in dedup_lines(docs, log2_bits=bits).collect()}
        assert len(got) == len(corpus)
        for i, t in corpus:
            lines = (t or "").split("\n")
            kept = [x for x in lines if len(key(x)) < 10 or i == min(holders[key(x)])]
            assert (got[i].n_lines, got[i].n_dropped, got[i].kept_text) == (len(lines), len(lines) - len(kept), "\n".join(kept))


def test_decontamination(spark, docs, corpus):
    text = max((t for _, t in corpus if t and t.count("\n") > 3), key=lambda t: len(set(t.split())))
    span = [w for w in text.split() if w][:40]
    changed = [w if k % 9 != 4 else "other" for k, w in enumerate(span)]
    items = spark.createDataFrame([(1, " ".join(span)), (2, " ".join(changed)), (3, " ".join(f"absent{k}" for k in range(30))), (4, None), (5, "")], "item_id long, text string")
    found = decontamination.find_leaks(docs, items).collect()
    holders = {i for i, t in corpus if t == text}
    assert {r.item_id for r in found if r.doc_id in holders} == {1, 2}
    assert not any(r.item_id > 2 for r in found)
    assert all(100 * r.n_equal >= 80 * r.n_tokens and r.n_tokens >= 13 for r in found)


def _missed(masks, size, changes, inside=0):
    """The patterns of so many changed places, at least `inside` places from both ends, that no mask hits."""
    return [c for c in combinations(range(inside, size - inside), changes) if not any(all(o + k not in c for k in m) for m in masks for o in range(size - m[-1]))]


@pytest.mark.parametrize("size, changes", [(13, 2), (15, 3), (20, 4), (25, 5)])
def test_masks_hit_all_patterns_of_a_fifth(size, changes):
    assert _missed(decontamination.MASKS, size, changes) == []


@pytest.mark.parametrize("size", range(5, 13))
def test_short_masks_hit_all_patterns_of_a_fifth(size):
    assert _missed(decontamination.SHORT_MASKS, size, size // 5) == [] and decontamination.fewest_seeds(size) > 0


def test_decontamination_finds_changed_ends_and_bounds_hot_phrases(spark, monkeypatch):
    """Items whose first and last tokens are changed are found, and a phrase that many share makes few candidates."""
    thirteen, five = [f"a{k}" for k in range(13)], [f"b{k}" for k in range(5)]
    docs = [(1, " ".join(["x", *thirteen[1:12], "y", "z"])), (2, " ".join(["q", *five[1:], "r"])), (3, " ".join(["q", "q", *five[2:], "r"]))]
    items = [(1, " ".join(thirteen)), (2, " ".join(five))]
    frame = lambda rows, c: spark.createDataFrame(rows, f"{c} long, text string")
    assert sorted((r.doc_id, r.item_id, r.n_equal) for r in decontamination.find_leaks(frame(docs, "doc_id"), frame(items, "item_id")).collect()) == [(1, 1, 11), (2, 2, 4)]
    candidates, write = [], decontamination.materialize

    def noted(df, what):
        candidates.append((what, write(df, what)))
        return candidates[-1][1]

    monkeypatch.setattr(decontamination, "materialize", noted)
    hot = "one very common phrase here"
    many = frame([(k, " ".join(f"d{k}_{j}" for j in range(20)) + f" {hot} " + " ".join(f"e{k}_{j}" for j in range(20))) for k in range(300)], "doc_id")
    asks = frame([(k, " ".join([*(f"i{k}_{j}" for j in range(k % 8)), hot, *(f"j{k}_{j}" for j in range(7 - k % 8))])) for k in range(80)], "item_id")
    assert decontamination.find_leaks(many, asks).collect() == [] and dict(candidates)["hits"].count() == 0


def test_decontamination_finds_every_overlap(spark):
    """All pairs of documents and items by brute force: whole, changed, cut, short, repeated and absent items."""
    rng = random.Random(8)
    word = lambda: f"t{rng.randrange(4000)}"
    items, docs = [], []
    for k in range(80):
        item = [word() for _ in range(rng.choice([3, 4, 5, 6, 7, 9, 10, 11, 12, 13, 14, 15, 15, 16, 20, 25, 33]))]
        copy = list(item)
        for p in rng.sample(range(len(item)), rng.randint(0, len(item) // 4)):
            copy[p] = "other"
        if rng.random() < 0.3:
            copy = copy[rng.randrange(5) : len(copy) - rng.randrange(5)]
        items.append((k, " ".join(item)))
        docs.append((k, " ".join([*(word() for _ in range(rng.randint(0, 40))), *copy, *(word() for _ in range(rng.randint(0, 40)))]).replace("t1", "T1, ")))
    fifteen = [f"s{k}" for k in range(15)]
    items += [(100, " ".join(fifteen)), (101, items[9][1]), (101, items[9][1]), (102, None), (103, "a b c d e a b c d e a b c")]
    docs += [(100, "x " + " ".join("y" if k in (2, 7, 11) else w for k, w in enumerate(fifteen)) + " z"), (101, None), (None, items[9][1]), (103, "a b c d e " * 8), (9, docs[9][1])]
    text = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("id", "item_id", "seed", "place", "found", "start")})
    bench = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("x") for c in ("id", "doc_id", "item", "seed")})
    got = {(r.doc_id, r.item_id): (r.n_tokens, r.n_equal, r.item_tokens) for r in decontamination.find_leaks(text, bench).collect()}
    tokens = lambda t: re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+", (t or "").translate(LOWER))
    want = {}
    for i, d in {(i, d) for i, d in docs if i is not None}:
        doc = tokens(d)
        for j, t in {(j, t) for j, t in items}:
            item = tokens(t)
            for shift in range(-len(item), len(doc)):
                same = [doc[shift + k] == item[k] for k in range(max(0, -shift), min(len(item), len(doc) - shift))]
                total = list(itertools.accumulate(same, initial=0))
                for a, b in combinations(range(len(same) + 1), 2):
                    n, equal = b - a, total[b] - total[a]
                    if len(item) >= 5 and n >= min(13, len(item)) and 100 * equal >= 80 * n:
                        want[i, j] = max(want.get((i, j), (0, 0, 0)), (n, equal, len(item)))
    assert got == want and (100, 100) in got and (103, 103) in got
    assert decontamination.find_leaks(text, bench.filter("item_id = 100")).count() == 1


def test_piece_codec(docs, corpus):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: r for r in encode_decode(docs, MODEL).collect()}
    for i, t in corpus:
        ids = model.encode(t or "")
        assert got[i].ids == ids and got[i].decoded == model.decode(ids)


@pytest.mark.parametrize("text", ["  a  b", "▁▁x", "<s> <0x0A>", "aaaaaaaaaaaa", " " * 33, "\n\n\t", "é ﬁ \U0001f600", "\x00"])
def test_piece_codec_odd_texts(spark, text):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    row = encode_decode(spark.createDataFrame([(1, text)], "doc_id long, text string"), MODEL).first()
    assert row.ids == model.encode(text) and row.decoded == model.decode(model.encode(text))


def test_warc(spark, tmp_path):
    html = ["<p>é</p>", "", None, "<p>é</p>", "x" * 70000, "", "<p>é</p>", "a\r\n\r\nb"]
    pages = spark.createDataFrame([(k, f"http://a.example/{k}?q=ü" if k != 3 else None, h) for k, h in enumerate(html)], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/w"
    index = write_archives(pages, folder)
    got = {r.page_id: r for r in read_records(index, folder).collect()}
    for k, h in enumerate(html):
        body = (h or "").encode()
        last = max(n for n, x in enumerate(html) if (x or "") == (h or ""))
        want = (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if k == last else "revisit", None if k == last else last)
        assert (got[k].payload_bytes, got[k].payload_digest, got[k].record_type, got[k].refers_to) == want
        assert got[k].payload == ((h or "") if k == last else None)
    some = read_records(index.filter("page_id in (4, 7)"), folder).collect()
    assert {r.page_id for r in some} == {4, 7}
    row = index.filter("page_id = 4").first()
    raw = open(f"{tmp_path}/w/{row.file}", "rb").read()[row.offset : row.offset + row.length]
    assert zlib.decompress(raw, 31).startswith(b"WARC/1.1\r\nWARC-Type: response")
    whole, heads = open(f"{tmp_path}/w/{row.file}", "rb").read(), []
    while whole:  # every member is a record, and the first one says what the file is
        member = zlib.decompressobj(31)
        heads.append(member.decompress(whole).split(b"\r\n")[1])
        whole = member.unused_data
    assert heads[0] == b"WARC-Type: warcinfo" and heads.count(heads[0]) == 1 and len(heads) == 1 + index.filter(F.col("file") == row.file).count()


def components(sets, percent):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("block", [1024, 4])
def test_minhash_dedup(docs, corpus, block, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    sets = {}
    for i, t in corpus:
        w = words((t or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()
    want = components(sets, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(docs, size=4).collect()}
    assert got == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}


def test_pseudonyms():
    f = Feistel(b"k")
    text = "card 4929348385146306, 4929 3483 8514 6306 not 4929348385146307; 129.38.82.176 999.1.1.1 +1 (017) 555-7713 2024-02-29 2023-02-29 und.34@mail7.example.com"
    new, found = pseudonymize(text, f)
    assert [k for k, _, _ in found] == ["email", "card", "card", "ipv4", "date", "phone"]
    cards = [re.sub(" ", "", p) for k, _, p in found if k == "card"]
    assert cards[0] == cards[1] != "4929348385146306" and luhn_digit(cards[0][:-1]) == cards[0][-1]
    for kept in ("4929348385146307", "999.1.1.1", "2023-02-29", "@mail7.example.com", "+1 (", ") "):
        assert kept in new
    assert len({f.digits(f"{n:03d}", 10, "t") for n in range(1000)}) == 1000
    assert pseudonymize(text, Feistel(b"other"))[0] != new and pseudonymize(text, f)[0] == new
    assert pseudonymize("nothing here, page 12", f) == ("nothing here, page 12", [])


def test_passage_dedup(docs, corpus):
    """Every document that repeats 50 words of an earlier one is found; one without 30 common words never is."""
    got = {r.doc_id: r for r in passage_dedup.repeated_passages(docs).collect()}
    seen = {n: {} for n in (20, 50)}
    for i, t in sorted(corpus):
        w = words((t or "").translate(LOWER))
        hits = {n: any(seen[n].setdefault(tuple(w[k : k + n]), i) != i for k in range(len(w) - n + 1)) for n in seen}
        if hits[50] and len(set(w)) > 1:
            assert i in got, i
    for r in got.values():
        text = dict(corpus)[r.doc_id]
        assert r.kept_text == "".join(text[a:b] for a, b in zip([0, *(e for _, e in r.spans)], [*(s for s, _ in r.spans), len(text)]))


def removed(corpus, length):
    first, out = {}, {}
    texts = sorted((i, (t or "").encode()) for i, t in corpus)
    for i, t in texts:
        for p in range(len(t) - length + 1):
            first.setdefault(t[p : p + length], (i, p))
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < (i, p):
                gone[p : p + length] = b"\1" * length
        out[i] = (len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(b for b, g in zip(t, gone) if not g))
    return out


@pytest.mark.parametrize("hot", [20000, 2])
def test_suffix_dedup(docs, corpus, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_STRETCHES", hot)
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == removed(corpus, 100)


def test_quality_rules(docs, corpus):
    got = {r.doc_id: r for r in clean_lines(docs).collect()}
    for i, t in corpus:
        w = words(t)
        where = collections.defaultdict(list)
        for k in range(len(w) - 2):
            where[tuple(w[k : k + 3])].append(k)
        repeat = {p + d for ps in where.values() if len(ps) > 1 for p in ps for d in range(3)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        r = got[i]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(repeat))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 50 or 100 * len(repeat) > 50 * len(w))
        assert not (r.kept and r.base_failed)


def test_quality_rules_lines(spark):
    good = " ".join(f"word{k} goes with text{k} here" for k in range(30)) + "."
    rows = [(1, good), (2, good + "\nHome | About | Log in | Search\nAll rights reserved."), (3, "\n".join(f"w{k}%% a{k}## b{k}$$ c{k}&&" for k in range(40)) + "\n" + good[:300])]
    got = {r.doc_id: r for r in clean_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].kept and got[1].clean_text == good
    assert got[2].kept and got[2].clean_text == good and got[2].n_failed_lines == 2
    assert not got[3].base_failed and not got[3].kept


def test_quality_rules_verdicts(spark, docs, corpus):
    """Every verdict and cleaned text against plain Python, on texts with menus, notices, shouts and symbols among good lines."""
    from .test_pipeline import clean_of, cleaned

    rng = random.Random(4)
    good = lambda: " ".join(f"w{rng.randrange(900)}" for _ in range(rng.randint(4, 30))) + rng.choice([".", "", "!", '."'])
    odd = ["Home", "About us", "Log in", "Shop »", "Say it.", "a | b | c | d", "A » B » C", "© 2020 Someone", "(c) 1999 x", "All rights reserved.", "Buy!! now!! today!!", "x## y## z$$ w%%", "", "  ", "no end", "Ünî cödé !?", "Buy it, now", 'He said "no."']
    rows = [(1000 + k, "\n".join(rng.choice(odd) if rng.random() < 0.5 else good() for _ in range(rng.randint(1, 14)))) for k in range(150)]
    texts = [*rows, *((i, t) for i, t in corpus)]
    got = {r.doc_id: r for r in clean_lines(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    for i, t in texts:
        assert got[i].clean_text == clean_of(t), t
        assert got[i].kept == (cleaned(t) is not None), t
    assert 10 < sum(r.kept for r in got.values()) < len(got) - 10


def test_quality_rules_keep_articles_in_one_line(spark):
    """A phrase in a long line is prose; a long word, or a text of one line, takes no more than linear time."""
    article = " ".join(f"word{k}" for k in range(60))
    rows = [(1, f"{article} a car powered by hydrogen {article.upper()}"), (2, f"{article} and all rights reserved."), (3, "x" * 1_000_000), (4, '."' * 500_000), (5, "!?" * 500_000)]
    began = time.time()
    got = {r.doc_id: r for r in clean_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert time.time() - began < 60
    assert got[1].kept and got[2].kept and got[1].n_failed_lines == got[2].n_failed_lines == 0
    assert got[3].n_words == 1 and not got[3].kept


@pytest.mark.parametrize("name", ["n_words", "KEPT", "doc_id"])
def test_carried_columns_must_not_clash(spark, name):
    with pytest.raises(ValueError, match="result's own"):
        clean_lines(spark.createDataFrame([(1, "x")], "doc_id long, text string").withColumn("KEPT", F.lit(1)), carry=[name])


def test_sharding(docs, corpus):
    dims = {"bytes": F.octet_length("text"), "source": F.crc32(F.col("source").cast("binary"))}
    got = kd_shards(docs, "doc_id", "text", dims, n_shards=16).collect()
    assert len(got) == len(corpus)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        body = (dict(corpus)[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(body) + 1, zlib.crc32(body))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(16))
    even = kd_shards(docs.filter("n_chars < 1000 and n_chars > 0"), "doc_id", "text", dims, n_shards=4).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    assert len(even) == 4 and max(r.b for r in even) - min(r.b for r in even) < 2500
    by_size = kd_shards(docs, "doc_id", "text", dims, target_bytes=8000)
    assert by_size.select("shard").distinct().count() > 4


def kd_tree(rows, depth, spread):
    """rows: (size, axes, id); the leaf of each row by recursion, as the operator's docstring has it."""
    if not depth or not rows:
        return {r: 0 for r in rows}
    axes = list(zip(*(r[1] for r in rows)))
    width = lambda a, k: (max(x for x in a if x is not None) - min(x for x in a if x is not None)) / max(1, spread[k]) if any(x is not None for x in a) else 0.0
    k = max(range(len(spread)), key=lambda k: (len(set(axes[k])) > 1, width(axes[k], k), -k))
    low = lambda x: -(2**61) if x is None else x
    order = sorted(rows, key=lambda r: (low(r[1][k]), low(r[1][-1])))
    half, run, cut = sum(r[0] for r in rows) / 2, 0, 0
    for at, r in enumerate(order):
        if run + r[0] >= half:
            cut = at + 1 if run == 0 or (at + 1 < len(order) and 2 * (half - run) >= r[0]) else at
            break
        run += r[0]
    left, right = kd_tree(order[:cut], depth - 1, spread), kd_tree(order[cut:], depth - 1, spread)
    return left | {r: v + 2 ** (depth - 1) for r, v in right.items()}


@pytest.mark.parametrize("ids", ["small", "wide"])
def test_sharding_by_brute_force(spark, ids):
    """Every row's leaf against a plain k-d tree, with ids over all 64 bits, null dimensions and equal texts."""
    rng = random.Random(2)
    some = rng.sample(range(500), 300) if ids == "small" else [-(2**63), 2**63 - 1, -(2**62) - 7, None, *(rng.randrange(-(2**63), 2**63) for _ in range(296))]
    rows = [(i, rng.choice(["same text " * 9, "x" * rng.randrange(2000), "", None]), rng.choice(["en", "de", "fr", None])) for i in some]
    lang = lambda x: None if x is None else zlib.crc32(x.encode())
    plain = [(len(t or "") + 1, (None if t is None else len(t), lang(g), i), i) for i, t, g in rows]
    spread = [max(x for r in plain if (x := r[1][k]) is not None) - min(x for r in plain if (x := r[1][k]) is not None) for k in range(3)]
    want = {r[2]: leaf for r, leaf in kd_tree(plain, 4, spread).items()}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = kd_shards(docs, "doc_id", "text", {"bytes": F.octet_length("text"), "lang": F.crc32(F.col("lang").cast("binary"))}, n_shards=16).collect()
    assert {r.doc_id: r.shard for r in got} == want
    sums = collections.Counter()
    for r in got:
        sums[r.shard] += r["size"]
    mean, largest = sum(sums.values()) / 16, max(r["size"] for r in got)
    assert len(sums) == 16 and all(abs(s - mean) < largest for s in sums.values())


def test_passage_dedup_without_sentences(spark):
    """Runs of 50 words without sentence ends, from mid-sentence, over short lines, in one long line: the whole run goes."""
    prose = lambda name, n: [f"{name}{k}" for k in range(n)]
    runs = {1: " ".join(prose("plain", 50)), 2: "\n".join(f"{a} {b}." for a, b in zip(prose("list", 60)[::2], prose("list", 60)[1::2])), 3: " ".join(prose("mid", 20)) + ". " + " ".join(prose("Mid", 35)), 4: " ".join(prose("long", 400))}
    rows = []
    for n, run in runs.items():
        for k in (10, 20):
            rows.append((n + k, " ".join(prose(f"before{n}_{k}_", 40)) + " " + run + " " + " ".join(prose(f"after{n}_{k}_", 40))))
    rows += [(50, " ".join(prose("some", 60))), (51, "SOME0 " + " ".join(prose("some", 60)[1:])), (52, "same " * 100)]
    got = {r.doc_id: r for r in passage_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    for n, run in runs.items():
        assert [texts[n + 20][a:b] for a, b in got.pop(n + 20).spans] == [run], n
    assert got.pop(51).kept_text == ""
    assert got.pop(52).n_words == 70
    assert not got


def test_passage_dedup_finds_every_run(spark):
    """Every word that a run of 50 words of an earlier place covers is removed, in documents of few words without sentence ends."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(3000)]
    texts = {}
    for i in range(60):
        parts = []
        for _ in range(4):
            a = rng.randrange(2900)
            parts += base[a : a + rng.randint(20, 90)] + [f"own{i}_{rng.randrange(99)}" for _ in range(rng.randint(0, 30))]
        texts[i] = " ".join(parts)
    got = {r.doc_id: r for r in passage_dedup.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)).collect()}
    seen, some = {}, 0
    for i, t in texts.items():
        w = t.split(" ")
        at = [0, *itertools.accumulate(len(x) + 1 for x in w)]
        for k in range(len(w) - 49):
            if seen.setdefault(tuple(w[k : k + 50]), i) != i:
                some += 1
                assert any(a <= at[k] and at[k + 50] - 1 <= b for a, b in got[i].spans), (i, k)
    assert some > 20


@pytest.mark.parametrize(
    "kind, text, value",
    [("iban", t, v) for t, v in (("DE89 3704 0044 0532 0130 00 BIC COBADEFF", "DE89 3704 0044 0532 0130 00"), ("DE89370400440532013000 2024-01-02", "DE89370400440532013000"), ("GB82 WEST 1234 5698 7654 32 A", "GB82 WEST 1234 5698 7654 32"), ("AB12 CDEF DE89370400440532013000", "DE89370400440532013000"))]
    + [("phone", t, t) for t in ("+49 30 12345678", "+33 1 23 45 67 89", "+4915112345678", "555.123.4567", "(555)123-4567", "(555) 123-4567", "030-555-1234")]
    + [("date", t, t) for t in ("12/31/2020", "3/5/2021", "31.12.2020", "2020-12-31", "2021-3-5")],
)
def test_pseudonyms_of_values_in_context(kind, text, value):
    new, found = pseudonymize(f"see {text}, thanks", Feistel(b"k"))
    assert (kind, value) in [(k, v) for k, v, _ in found]
    assert value not in new and new.startswith("see ") and new.endswith(", thanks")
    again = next(p for k, v, p in found if v == value)
    assert kind == "phone" or re.sub(r"\d", "", again) == re.sub(r"\d", "", value)


def test_pseudonyms_of_local_parts_beyond_ascii():
    """No letter or digit of a local part stays by rule; different local parts stay different, equal ones equal."""
    feistel = Feistel(b"k")
    for address in ("müller@example.com", "Ärger.Nr7@mail.example.org", "иван.петров@example.com", "Γιώργος99@example.com", "mu\u0308ller@example.com", "é@example.com"):
        new, found = pseudonymize(f"to {address}, thanks", feistel)
        assert [(k, v) for k, v, _ in found] == [("email", address)]
        local, made = address.split("@")[0], found[0][2].split("@")[0]
        assert new == f"to {found[0][2]}, thanks" and found[0][2].endswith(address[len(local) :]) and len(made) == len(local)
        assert all((x.isalpha(), x.isdigit(), x.isupper()) == (y.isalpha(), y.isdigit(), y.isupper()) for x, y in zip(local, made))
        assert made != local and pseudonymize(address, feistel)[0] == found[0][2]
    assert pseudonymize("写信user@example.com", feistel)[1][0][1] == "user@example.com"
    letters = [c for c in map(chr, range(0xC0, 0x180)) if c.isalpha()]
    addresses = [f"{a}{b}@example.com" for a in letters for b in letters]
    assert len({pseudonymize(a, feistel)[0] for a in addresses}) == len(addresses)


def test_pseudonyms_of_random_texts():
    """Every planted valid value of each kind is found, whole and alone; invalid ones and plain prose are left; formats stay."""
    rng = random.Random(6)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        body = rng.choice("2456") + digits(14)
        return body + luhn_digit(body)

    def iban():
        country, length = rng.choice([("DE", 22), ("AT", 20), ("BE", 16), ("FR", 27)])
        body = digits(length - 4)
        number = int("".join(str(int(c, 36)) for c in body + country + "00"))
        return f"{country}{98 - number % 97:02d}{body}"

    def day():
        d = datetime.date(1900, 1, 1) + datetime.timedelta(rng.randrange(73049))
        return rng.choice([d.isoformat(), d.strftime("%d.%m.%Y"), d.strftime("%d/%m/%Y")])

    def cased():
        text = "".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(16, 40)))
        return rng.choice([text, text.upper()])

    make = {
        "card": card, "iban": iban, "date": day, "ipv4": lambda: ".".join(str(rng.randrange(256)) for _ in range(4)), "email": lambda: f"{rng.choice('abcxyz')}{digits(3)}.{rng.choice('qrs')}@mail{rng.randrange(9)}.example.org",
        "ssn": lambda: f"{rng.randint(1, 665):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}", "phone": lambda: f"+49 {rng.randint(100, 999)} {digits(7)}", "secret": lambda: f"{rng.choice(['token', 'API_KEY', 'password'])}={cased()}",
    }
    f, seen = Feistel(b"k"), {}
    for _ in range(400):
        planted, parts = [], []
        for kind in rng.choices(list(make), k=rng.randint(0, 5)):
            value = make[kind]()
            planted.append((kind, value))
            parts += [rng.choice(["see", "and then", "word", "Straße"]), value, rng.choice([",", " and", ";"])]
        text = " ".join(["begin", *parts, "end"])
        new, found = pseudonymize(text, f)
        assert sorted((k, v) for k, v, _ in found) == sorted(planted), text
        shape = lambda t: re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", t)))
        for kind, value, fake in found:
            assert seen.setdefault((kind, value), fake) == fake
            if kind == "ipv4":  # a dotted quad again, of any length
                assert all(0 <= int(x) < 256 for x in fake.split(".")) and fake.count(".") == 3
            else:
                assert len(fake) == len(value) and (kind == "secret" or shape(fake) == shape(value)), (kind, value, fake)
            assert kind != "secret" or (fake.isupper() if value.split("=")[1].isupper() and fake.split("=")[0].isupper() else True)
        rest = text
        for _, value, _ in found:
            rest = rest.replace(value, "\0", 1)
        masked = new
        for _, _, fake in found:
            masked = masked.replace(fake, "\0", 1)
        assert masked == rest
    assert len(set(seen.values())) == len(seen)
    assert pseudonymize("token=DEADBEEFDEADBEEF", f)[1][0][0] == "secret"


def test_pseudonyms_leave_numbers_alone():
    text = "v12.345.678 12.345.678 13/32/2020 2021.3.5 DE89370400440532013001"
    assert pseudonymize(text, Feistel(b"k"))[1] == []
    dates = ["12/31/2020", "31/12/2020", "3/5/2021", "03/05/2021", "5/3/2021"]
    new = [pseudonymize(d, Feistel(b"k"))[0] for d in dates]
    assert len(set(new)) == 5
    spellings = [re.sub(r"\D", "", pseudonymize(t, Feistel(b"k"))[0]) for t in ("+4915112345678", "+49 151 12345678", "+49 (151) 123-45678")]
    assert len(set(spellings)) == 1


def test_suffix_dedup_gathers_no_hot_key(spark, monkeypatch):
    """A passage in many documents with different text around it: no key of gathered bytes has more rows than an anchor may."""
    monkeypatch.setattr(suffix_dedup, "HOT_STRETCHES", 5)
    rng = random.Random(3)
    noise = lambda: "".join(rng.choice("abcdefghijklmnop ") for _ in range(150))
    passage = noise()
    rows = [(k, noise() + passage + noise()) for k in range(60)]
    texts = spark.createDataFrame(rows, "id long, text string")
    open_ = suffix_dedup._sorted_out(suffix_dedup._anchored(texts, 100)).filter("h is not null")
    gathered = suffix_dedup._gathered(texts, open_, 100)
    pieces = gathered[0] if isinstance(gathered, tuple) else gathered
    assert (pieces.groupBy("key").count().agg(F.max("count")).first()[0] or 0) <= 5
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in suffix_dedup.remove_repeats(texts.withColumnRenamed("id", "doc_id")).collect()}
    assert got == removed(rows, 100) and got[1][1] == 150


def test_suffix_dedup_shuffles_texts_for_the_last_join_alone(spark, docs, monkeypatch):
    """With hot anchors too: what they need of the texts is a hot stretch's bytes."""
    monkeypatch.setattr(suffix_dedup, "HOT_STRETCHES", 2)
    plans, write = {}, suffix_dedup.materialize

    def noted(df, what):
        plans[what] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(df, what)

    monkeypatch.setattr(suffix_dedup, "materialize", noted)
    suffix_dedup.remove_repeats(docs)
    assert "Join LeftSemi" in plans["hot-windows"] and "LeftOuter" not in plans["hot-windows"]  # of whole texts, before

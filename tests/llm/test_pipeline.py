"""run() against a plain Python version of all five stages."""

import collections
import re

import public_tokenizers
import sentencepiece

import corpus_pipeline
from tapewright.llm.quality_rules import BOILERPLATE

from .test_results import LOWER, SPACES, components, words


def line_fails(line):
    bare, n = re.sub(r"[\x20\x09-\x0D]+", "", line), len(words(line))
    symbols, shouts = len(re.findall(r"[#*$%&|<>{}\[\]=~^`\\]", bare)), len(re.findall(r"(?<=[!?])[!?]", bare))
    separators = len(re.findall(r"[|»›•·]", bare))
    notice = n <= 12 and len(line) <= 240 and re.search(rf"(?i)©|\(c\) ?\d{{4}}|\b(?:{'|'.join(BOILERPLATE)})\b", line)
    return symbols > 0.1 * len(bare) or shouts * 12 > 0.3 * len(bare) or (separators >= 3 and separators * 60 >= len(bare)) or notice


def menu_item(line):
    return len(words(line)) <= 3 and len(line) <= 60 and not re.search(r"""[.!?:;,…。！？]["'”’»)\]]*$""", re.sub(r"[\x20\x09-\x0D]+", "", line))


def clean_of(text):
    """The lines that stay, whatever becomes of the document."""
    lines = [x for x in (text or "").split("\n") if words(x)]
    items = [menu_item(x) for x in lines]
    runs = [any(k >= 0 and all(items[k : k + 3]) and len(items[k : k + 3]) == 3 for k in (i - 2, i - 1, i)) for i in range(len(lines))]
    return "\n".join(x for x in dict.fromkeys(x for x, r in zip(lines, runs) if not r) if not line_fails(x))


def cleaned(text):
    w = words(text)
    windows = collections.defaultdict(list)
    for k in range(len(w) - 2):
        windows[tuple(w[k : k + 3])].append(k)
    repeat = {k + d for ks in windows.values() if len(ks) > 1 for k in ks for d in range(3)}
    kept = clean_of(text)
    return None if len(w) < 50 or 2 * len(repeat) > len(w) or len(words(kept)) < 0.5 * len(w) else kept


def leaks(text, items):
    tokens = lambda t: re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+", t.translate(LOWER))
    doc = tokens(text)
    for item in map(tokens, items):
        for d in range(-len(item), len(doc)):
            same = [doc[d + k] == item[k] for k in range(max(0, -d), min(len(item), len(doc) - d))]
            for a in range(len(same)):
                for b in range(a + min(13, len(item)), len(same) + 1):
                    if 100 * sum(same[a:b]) >= 80 * (b - a):
                        return True
    return False


def test_run(spark, docs, corpus, tmp_path):
    short = dict(corpus) | {404: "spark " * 60}
    texts = {i: c for i, t in short.items() if (c := cleaned(t)) is not None}
    key = lambda line: line.strip(SPACES).translate(LOWER)
    first = {}
    for i in sorted(texts):
        for line in texts[i].split("\n"):
            first.setdefault(key(line), i)
    texts = {i: "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or first[key(x)] == i) for i, t in texts.items()}
    texts = {i: t for i, t in texts.items() if t}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w := words(t.translate(LOWER))) >= 5 else ({tuple(w)} if w else set()) for i, t in texts.items()}
    texts = {i: texts[i] for i, c in components(sets, 80).items() if c == i}
    items = [" ".join(words(texts[min(texts)])[:20]), " ".join(f"absent{k}" for k in range(20))]
    want = {i: t for i, t in texts.items() if not leaks(t, items)}
    assert 0 < len(want) < len(texts)

    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in short.items()], docs.schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert set(got) == set(want)
    assert all(got[i].ids == model.encode(t) and got[i].n_tokens == len(got[i].ids) and got[i].round_trip for i, t in want.items())

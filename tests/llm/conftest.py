import random

import pytest


@pytest.fixture(scope="session")
def corpus():
    """Small documents with copies, near copies, shared lines and passages, odd white space and several scripts."""
    rng = random.Random(11)
    words = ["the", "of", "und", "que", "été", "Straße", "data", "line", "spark", "日本", "x1", "Again", "node", "plan", "vers", "ende"]
    sentence = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", str(rng.randint(0, 99))]) for _ in range(n)) + "."
    shared = [sentence(12) for _ in range(4)]
    passage = " ".join(sentence(12) for _ in range(6))
    out: list[tuple[int, str | None]] = []
    for k in range(60):
        lines = [sentence(rng.randint(3, 40)) for _ in range(rng.randint(1, 6))]
        if k % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), rng.choice(["", "  ", "\t"]) + rng.choice(shared).upper() + rng.choice(["", " \r"]))
        if k % 7 == 0:
            lines[0] = lines[0] + " " + passage + " " + sentence(5)
        out.append((k * 3, "\n".join(lines)))
    for k in range(10):
        text = out[k][1].split(" ")
        text[rng.randrange(len(text))] = "edit"
        out.append((200 + k, " ".join(text)))
        out.append((300 + k, out[k][1]))
    out += [(400, None), (401, ""), (402, " \t\n "), (403, "a"), (404, "spark " * 3000), (405, "é" * 5000), (406, "a b c")]
    rng.shuffle(out)
    return out


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame([(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in corpus], "doc_id long, text string, lang string, source string, n_chars long")

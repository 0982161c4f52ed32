"""A small table of documents with awkward rows, and plain rewritings of the contracts."""

import random
from collections import Counter

WORDS = ["".join(random.Random(k).choices("abcdeéñß日", k=1 + k % 7)) for k in range(60)]
CLASHING = "key long, n long, size long, words string, h1 long, block long, label string, class string, t string, hits string, " \
           "row string, lose string, single string, component string, k string, source_size long"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


def corpus(seed: int = 3, n: int = 90) -> list[tuple]:
    rng = random.Random(seed)
    shared_line = "This Line is shared by many documents of the corpus."
    passage = " ".join(rng.choices(WORDS, k=70))
    texts = []
    for k in range(n):
        text = "\n".join(" ".join(rng.choices(WORDS, k=rng.randint(3, 25))) for _ in range(rng.randint(1, 5)))
        if k % 5 == 0:
            text += "\n  " + (shared_line.upper() if k % 10 else shared_line) + "\t"
        if k % 7 == 0:
            text = passage + " " + text
        texts.append(text)
    for k in range(0, n, 6):                        # near copies, some with another line end
        words = texts[k].split(" ")
        words[rng.randrange(len(words))] = "edit"
        texts.append(" ".join(words))
    texts += [texts[1], texts[1].upper(), texts[2] + "\r", "", "   \n\t ", "one", "ONE", "two words", None, None,
              " ".join(rng.choices(WORDS, k=6000)), "ab " * 150, "\x00\x01" * 150, shared_line + "\n" + shared_line]
    rows = [(k, t, ["en", "fr", None][k % 3], [None, "b", "a", "é"][k % 4]) for k, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, texts[3], "en", "a"), (None, None, None, None), (4, "other text, same id", "fr", "b")]
    return [r + (None if r[1] is None else len(r[1]),) + (7,) * 3 + ("x", 8, 9) + ("y",) * 9 + (5,) for r in rows]


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


def repeated_mask(items, size, counts: Counter):
    mask = [False] * len(items)
    for i in range(len(items) - size + 1):
        if counts[tuple(items[i:i + size])] > 1:
            mask[i:i + size] = [True] * size
    return mask


def window_counts(many, size) -> Counter:
    return Counter(tuple(x[i:i + size]) for x in many for i in range(len(x) - size + 1))

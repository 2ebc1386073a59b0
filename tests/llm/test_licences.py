import random
import textwrap
import time

from pyspark.sql import functions as F

from gondola.llm.licences import TEMPLATES, Scanner, bigrams, scan
from gondola.llm.toxicity import tokens


def plain(text, threshold):
    out = []
    for name, body in TEMPLATES.items():
        a, b = bigrams(text), bigrams(body)
        if a and b and 2 * len(a & b) / (len(a) + len(b)) >= threshold:
            out.append((name, 2 * len(a & b) / (len(a) + len(b))))
    return sorted(out)


def test_size_bounds_lose_nothing():
    texts = list(TEMPLATES.values())
    texts += [t + " And a few more words." for t in texts] + [t.upper().replace(" ", "  ") for t in texts] + [" ".join(t.split()[:-2]) for t in texts]
    for threshold in (0.3, 0.8, 0.95):
        ready = Scanner(TEMPLATES, threshold)
        for t in texts:
            assert sorted(ready.matches(t)) == plain(t, threshold)


def test_lines_paragraphs_and_defined_cases(documents):
    wrapped = TEMPLATES["MIT grant"].replace("software", "software\n", 1)
    rows = [(1, "Some prose.\nAll rights reserved\nmore"), (2, f"intro\n\n{wrapped}\n \nend"), (2, "x"), (None, "released under the MIT license"),
            (4, None), (5, ""), (6, "w " * 50_000), (7, "all")]
    docs = documents(rows).withColumn("unit", F.lit(1)).withColumn("found", F.lit("clash"))
    got = {(r["doc_id"], r["unit"], r["unit_no"], r["licence"]) for r in scan(docs).collect() if r["unit"] != "window"}
    assert got == {(1, "line", 1, "Proprietary"), (2, "paragraph", 1, "MIT grant"), (None, "line", 0, "MIT")} | {
        x for x in got if x[:2] == (2, "line") and x[3] == "MIT grant"}
    assert scan(documents([])).collect() == [] and scan(docs, {}).collect() == []


def plain_windows(text, threshold):
    """Every window against every template; the best of each run."""
    words, out = tokens(text), []
    for name, body in TEMPLATES.items():
        other, width = bigrams(body), len(tokens(body))
        run = None
        for start in range(max(0, len(words) - width) + 1):
            own = set(zip(words[start : start + width], words[start + 1 : start + width]))
            dice = 2 * len(own & other) / (len(own) + len(other))
            if dice < threshold:
                run = None
            elif run is None:
                out.append(run := [start, name, dice])
            elif dice > run[2]:
                run[0], run[2] = start, dice
    return sorted(map(tuple, out))


def test_windows_against_all_windows():
    draw = random.Random(3)
    names = list(TEMPLATES)
    words = [w for t in TEMPLATES.values() for w in t.split()]
    texts = ["", "mit", "Released under the MIT", *TEMPLATES.values()]
    for _ in range(25):
        parts = []
        for _ in range(draw.randrange(1, 6)):
            body = TEMPLATES[draw.choice(names)].split()
            kept = [w for w in body if draw.random() > draw.choice([0, 0.02, 0.1])]
            parts += kept * draw.choice([1, 1, 2]) + draw.choices(words, k=draw.randrange(40))
        texts.append(" ".join(parts))
    for threshold in (0.5, 0.8, 0.95):
        ready = Scanner(TEMPLATES, threshold)
        for text in texts:
            assert sorted(ready.windows(tokens(text))) == plain_windows(text, threshold)


def test_notices_inside_lines_and_comment_blocks(documents):
    def comment(text):
        return "/*\n" + "\n".join(f" * {x}" for x in textwrap.wrap(text, 60)) + "\n */"

    grant, whole = TEMPLATES["MIT grant"], TEMPLATES["MIT text"]
    block = "/*\n * " + grant.replace("files", "files\n * ") + "\n *\n * " + whole[len(grant):].replace("IN NO EVENT", "\n * IN NO EVENT") + "\n */"
    rows = [(1, "My tool, written in spring. Released under the MIT License. Have fun with it and tell me."), (2, block),
            (3, "intro words " * 50 + comment(TEMPLATES["BSD-3-Clause text"]) + " code follows" * 50), (4, "released plainly under no license of mine " * 30)]
    got = {}
    for r in scan(documents(rows)).collect():
        got.setdefault(r["doc_id"], set()).add((r["unit"], r["licence"]))
    assert got[1] == {("window", "MIT")}
    assert {("paragraph", "MIT grant"), ("window", "MIT text"), ("window", "MIT grant")} <= got[2]
    assert {n for u, n in got[3] if u == "window"} == {"BSD", "BSD-2-Clause text", "BSD-3-Clause text"} and 4 not in got


def test_windows_of_long_dense_texts_take_linear_time():
    ready, text = Scanner(TEMPLATES, 0.8), TEMPLATES["MIT text"] + " "
    took = []
    for n in (100, 400):
        words = tokens(text * n)
        begin = time.process_time()
        found = ready.windows(words)
        took.append(time.process_time() - begin)
        assert sum(name == "MIT text" for _, name, _ in found) >= 1
    assert took[1] < 12 * took[0]

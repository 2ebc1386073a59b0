import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from gondola.llm.line_rules import line_rules

WORD = r"[^\x20\x09-\x0D]+"


def plain(rows, share=0.05, at_least=20, keep_share=0.3, limit=200, line_words=3):
    def lines(text):
        return [x for x in (text or "").split("\n") if re.search(WORD, x)]

    def norm(x):
        return " ".join(re.findall(WORD, x.lower()))

    holders, hosts = defaultdict(set), Counter(s for *_, s in rows)
    for i, (_, text, host) in enumerate(rows):
        for x in lines(text):
            holders[host, norm(x)].add(i)
    out = []
    for doc_id, text, host in rows:
        words = re.findall(WORD, text or "")
        grams = Counter(zip(words, words[1:], words[2:]))
        repeat = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
        lost = sum(len(re.findall(WORD, x)) for x in lines(text)
                   if (n := len(holders[host, norm(x)])) > max(at_least, share * hosts[host])
                   or n > limit and len(norm(x).split(" ")) >= line_words)
        failed = len(words) < 50 or 100 * len(repeat) > 50 * len(words)
        out.append((doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
                    len(lines(text)) - len(set(lines(text))), len(repeat), lost, failed,
                    not failed and len(words) - lost >= keep_share * len(words)))
    return sorted(out, key=str)


def test_against_brute_force(documents):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)] + ["É", "#a", "$$", "|"]
    common = " ".join(rng.choice(words) for _ in range(40))
    rows = []
    for i in range(150):
        own = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 30))) for _ in range(rng.randrange(6))]
        if i % 3 == 0:
            own += [common.upper() if i % 2 else common + " \t", ""]
        if i % 7 == 0:
            own += own[:1] * 3
        rows.append((i, "\n".join(own), ["a", "b", None][i % 3 if i % 3 else 0]))
    rows += [(500, None, "a"), (500, None, "a"), (None, "", None), (501, " \t\n\x0b", "a"), (502, "rep eat it " * 20_000, "b"), (503, "a b", "b")]
    docs = documents(rows).withColumn("words", F.lit("clash")).withColumn("line", F.lit(1)).withColumn("row", F.lit(2))
    got = line_rules(docs)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_line_words", "base_failed", "kept"]
    found = sorted((tuple(r[n] for n in names) for r in got.collect()), key=str)
    assert found == plain(rows)
    assert any(r[6] for r in found) and any(r[-1] for r in found) and not all(r[-1] for r in found)
    assert line_rules(documents([])).collect() == []


def test_hot_host_does_not_hide_its_lines(documents):
    """In a host of 2,000 documents, 30 hold a line, and a limit of 25 removes it as it would in a small host; short lines are left to the share."""
    rng = random.Random(3)
    shared, short = "one line that many documents of this host hold", "two words"
    rows = []
    for i in range(2000):
        own = " ".join(f"w{rng.randrange(500)}" for _ in range(60))
        rows.append((i, "\n".join([own, *([shared] if i < 30 else []), *([short] if i % 50 == 0 else [])]), "hot"))
    rows += [(5000 + i, shared, "small") for i in range(10)]
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_line_words", "base_failed", "kept"]
    got = line_rules(documents(rows), limit=25)
    found = sorted((tuple(r[n] for n in names) for r in got.collect()), key=str)
    assert found == plain(rows, limit=25)
    assert sum(r[6] for r in found) == 30 * 9

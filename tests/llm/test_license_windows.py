"""Notices that run over line ends or stand inside paragraphs, and whole licence texts."""
import random
import re
import textwrap

import pytest
from tests_llm_helpers import corpus, got, make, package, sentence  # noqa: F401
from tessera.llm import licenses as li


def ws(text):
    return [w for w in re.split(r"[^a-z0-9.+\x80-\U0010FFFF]+", text.lower()) if w]


def best_window(text, body, t=li.THRESHOLD):
    """Best score of any window of at most (2-t)/t times the template's bigrams."""
    w, known = ws(text), set(li.template_bigrams(body))
    pairs = [f"{a} {b}" for a, b in zip(w, w[1:])]
    span = int((len(ws(body)) - 1) * (2 - t) / t + 1e-9)
    best = 0
    for i in range(len(pairs)):
        seen = set()
        for j in range(i, min(len(pairs), i + span)):
            seen.add(pairs[j])
            best = max(best, 2 * len(seen & known) / (len(seen) + len(known)))
    return best


def wrapped(text, mark=""):
    return "\n".join(mark + x for x in textwrap.wrap(text, 78 - len(mark)))


def test_wrapped_notices_in_longer_documents(make):
    rng = random.Random(1)
    rows, want = [], {}
    for k, (name, body) in enumerate(li.TEMPLATES.items()):
        rows.append((2 * k, wrapped(body, " * ") + "\n" + "\n".join(sentence(rng, 12) for _ in range(60)), "en", "s", 1))
        prose = sentence(rng, 90) + " " + body + " " + sentence(rng, 90)      # a sentence within a paragraph
        rows.append((2 * k + 1, prose, "en", "s", 1))
        want[2 * k] = want[2 * k + 1] = name
    res = {r["doc_id"]: r for r in got(li.scan(make(rows)))}
    for i, name in want.items():
        assert name in res[i]["licenses"].split(","), (i, name)
        assert res[i]["score"] == 1.0 and res[i]["license"] == name
    # a notice that a larger one holds is no find of its own
    header = list(li.TEMPLATES).index("Apache-2.0-header")
    assert res[2 * header]["licenses"] == "Apache-2.0-header"
    nc = list(li.TEMPLATES).index("CC-BY-NC-4.0")
    assert "CC-BY-4.0" not in res[2 * nc + 1]["licenses"]


@pytest.mark.parametrize("name", sorted(li.TEXTS))
def test_whole_texts(make, name):
    body = li.TEXTS[name]
    one = " ".join(body.split())
    rows = [(1, body, "en", "s", 1), (2, one, "en", "s", 1), (3, wrapped(one), "en", "s", 1),
            (4, "Copyright (c) 2020 A. Person\n\n" + "\n".join(["other words here"] * 40) + "\n" + wrapped(one, "# ") + "\nand code", "en", "s", 1)]
    for r in got(li.scan(make(rows))):
        assert name in r["licenses"].split(",") and r["score"] == 1.0, r


def test_windows_match_all_windows(make):
    """Names against every window of every text, on edited notices."""
    rng = random.Random(7)
    names = ["MIT", "CC-BY-SA-4.0", "GPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense"]
    small = {k: li.TEMPLATES[k] for k in names}
    rows = []
    for i in range(60):
        w = small[names[i % 6]].split()
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(w))
            w[at:at + rng.randint(0, 1)] = ["edited"] * rng.randint(0, 2)
        rows.append((i, sentence(rng, 25) + " " + "\n".join(textwrap.wrap(" ".join(w), 30)) + " " + sentence(rng, 25), "en", "s", 1))
    res = {r["doc_id"]: r for r in got(li.scan(make(rows), small))}
    hits = 0
    for r in rows:
        scores = {k: best_window(r[1], v) for k, v in small.items()}
        best = max(scores.values())
        assert (res[r[0]]["license"] is not None) == (best >= li.THRESHOLD), r
        if best >= li.THRESHOLD:
            hits += 1
            assert res[r[0]]["score"] == pytest.approx(best)
    assert 10 < hits < 60


def test_places_are_counted(make):
    mit = li.TEMPLATES["MIT"]
    rows = [(1, f"It is {mit.replace(' the', chr(10) + 'the')} More words follow here and {mit} That is all of it.", "en", "s", 1), (2, "no licence\nat all", "en", "s", 1)]
    res = {r["doc_id"]: r for r in got(li.scan(make(rows)))}
    assert (res[1]["n_matched"], res[1]["licenses"], res[1]["score"]) == (2, "MIT", 1.0)
    assert (res[2]["n_matched"], res[2]["license"]) == (0, None)


def test_the_best_end_may_be_any(make):
    """A window whose first ends score better than they are: words of the
    notice come again after it, so that many ends look alike."""
    body = "alpha beta gamma delta epsilon zeta eta theta"
    noise = " ".join(f"beta gamma x{k}" for k in range(3))
    rows, want = [], {}
    rng = random.Random(11)
    for i in range(40):
        w = body.split()
        w.insert(rng.randrange(1, 8), "cut")
        text = "start " + " ".join(w) + " " + " ".join(rng.choice(["beta gamma", "zeta eta", "delta epsilon", "q r"]) for _ in range(6)) + " " + noise
        rows.append((i, text, "en", "s", 1))
        want[i] = best_window(text, body)
    res = {r["doc_id"]: r for r in got(li.scan(make(rows), {"X": body}))}
    for i, best in want.items():
        assert (res[i]["score"] or 0) == pytest.approx(best if best >= li.THRESHOLD else 0), i

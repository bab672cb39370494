import hashlib

from tests_llm_helpers import corpus, edge_rows, got, make, package  # noqa: F401
from tessera.llm import fingerprint as fp


def expected(rows):
    """Plain loop over rows sorted as the operator says; null ids first."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    first = next((k for k, r in enumerate(rows) if r[0] is not None), 0)
    out = []
    for k, r in enumerate(rows):
        nxt = rows[k + 1] if k + 1 < len(rows) else rows[first]
        t, n = r[1] or "", nxt[1] or ""
        half = len(t) // 2
        e = t[:len(t) - half] + n[:half]
        out.append((r[0], len(t), hashlib.sha256(e.encode()).hexdigest(), fp.of_text(t).hex(), fp.of_text(e).hex(),
                    fp.likeness(fp.of_text(t), fp.of_text(e)), fp.likeness(fp.of_text(t), fp.of_text(n))))
    return sorted(out, key=str)


def test_matches_plain_loop(make):
    for rows in (corpus(), edge_rows(), [(9, "alone. and. so", None, None, 1)], []):
        assert sorted(map(lambda r: tuple(r.values()), got(fp.fingerprints(make(rows)))), key=str) == expected(rows)


def test_homomorphic():
    a, b = fp.of_text("one two.\nthree four"), fp.of_text("five, six")
    assert (a + b).hex() == fp.of_text("five, six\nthree four\none two.").hex()
    assert (a + b - b).hex() == a.hex() and (a - a).hex() == fp.of_text(None).hex()
    assert fp.Fingerprint.of_hex(a.hex()).hex() == a.hex()
    assert fp.likeness(a, a) == 1 and fp.likeness(a, fp.of_text("")) == 0 and fp.likeness(fp.of_text(""), fp.of_text(None)) == 1


def test_likeness_estimates_shared_share():
    one = "\n".join(f"line number {k} of the text" for k in range(100))
    two = "\n".join(f"line number {k} of the text" for k in range(50, 150))
    assert abs(fp.likeness(fp.of_text(one), fp.of_text(two)) - 0.5) < 0.2
    # wide sparse ids: the next id is found across distant groups


def test_sparse_ids(make):
    rows = [(i, f"text {i}. more", None, None, 1) for i in (-2 ** 62, -5, 0, 1, 1023, 1024, 2 ** 40, 2 ** 62)]
    assert sorted(map(lambda r: tuple(r.values()), got(fp.fingerprints(make(rows)))), key=str) == expected(rows)


def test_many_repeats_keep_their_likeness():
    line = "the same line"
    of = lambda n: fp.of_text("\n".join([line] * n))
    assert fp.likeness(of(65_536), of(65_537)) > 0.999 and fp.likeness(of(40_000), of(20_000)) > 0.999
    assert fp.likeness(of(70_000), fp.of_text("another line")) < 0.3


def test_texts_without_marks_share_pieces_after_an_edit():
    import random
    rng = random.Random(3)
    words = " ".join(f"w{rng.randrange(10**6)}" for _ in range(20_000))
    kana = "".join(chr(rng.randrange(0x3042, 0x3090)) for _ in range(9_000))
    other = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(9_000))
    for text, nxt in ((words, "x" * 5), (words, words[::-1]), (kana, other), ("k" + kana, "")):
        half = fp.edited(text, nxt)
        # 256 lanes estimate a half with a standard error of a sixteenth
        assert 0.3 < fp.likeness(fp.of_text(text), fp.of_text(half)) < 0.95, len(half)
        assert fp.likeness(fp.of_text(text), fp.of_text(text[:100] + "!" + text[100:])) > 0.9


def test_sums_over_a_seam_are_those_of_the_whole():
    import random
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice(["a", "bc ", ". ", ", ", "\n", "!", "? ", " ", "Ünïcode", "word " * 60, "x" * 200]) for _ in range(rng.randrange(30)))
        for at in (len(text) - len(text) // 2, rng.randint(0, len(text))):
            cut = fp.seam(text, at)
            assert 0 <= cut <= at
            for end in (text[cut:], text[cut:at] + rng.choice(["", " new. end", "\n", "z" * 300])):
                assert (fp.of_text(text[:cut]) + fp.of_text(end)).hex() == fp.of_text(text[:cut] + end).hex()

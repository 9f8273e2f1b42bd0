import random
import re

import pytest

from homeledger.llm import notices, queries
from homeledger.llm.notices import NOTICES, PHRASES, Matcher, Notice, best_spans, scan_text, word_text

SEARCH = Matcher(PHRASES, NOTICES)


def fewest_errors(text, notice):
    """Of all stretches between word borders within the bound, by the edit-distance table."""
    best, n, k = None, len(notice.text), notice.errors
    for s in (i + 1 for i, c in enumerate(text[:-1]) if c == " "):
        row = list(range(n + 1))
        for i in range(min(n + k, len(text) - s)):
            new = [i + 1]
            for j in range(1, n + 1):
                new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (notice.text[j - 1] != text[s + i])))
            row, stop = new, s + i + 1
            if text[stop:stop + 1] == " " and row[n] <= k and (not notice.fixed or f" {notice.fixed} " in f" {text[s:stop]} "):
                best = row[n] if best is None else min(best, row[n])
    return best


def test_matches_equal_brute_force():
    rng = random.Random(6)
    for _ in range(150):
        letters = list(rng.choice(NOTICES).text)
        for _ in range(rng.randrange(6)):
            i = rng.randrange(len(letters))
            letters[i:i + rng.randrange(2)] = rng.choice(["", "a", "c", "x", " "])
        text = word_text(f"{rng.choice(['foo', 'the', 'license'])} a {''.join(letters)} {rng.choice(['x', 'license mit', ''])}")
        for i, notice in enumerate(NOTICES):
            alone = Matcher({}, (notice,))
            assert min((m[3] for m in alone.fuzzy(text)), default=None) == fewest_errors(text, notice), (text, notice)


def test_words_and_exact_phrases():
    text = "MIT\tLicense; the-mit.license É mit licenses General  Public\nLicense\x7fx"
    n, exact, _ = scan_text(text, SEARCH)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    assert n == len(words) == 12 and exact == [("mit", 0), ("mit", 3), ("gpl", 8)]
    for text in (None, "", " ", "...", "mit", "license mit"):
        assert scan_text(text, SEARCH)[1:] == ([], [])


@pytest.mark.parametrize("text, label, errors", [
    ("under the MIT Licence.", "mit", 1), ("MIT-Lisense", "mit", 1), ("Apache Licsense 2", "apache", 1), ("the Generel Public Lisense v3", "gpl", 2),
    ("Permission is hereby granted, free of charge", "mit", 0), ("Redistribution and use in sourse and binary form", "bsd", 2),
    ("licensed under CC BY-NC 4.0", "cc", 0), ("GNU Lesser General Public License", "lgpl", 0)])
def test_notices_are_found(text, label, errors):
    spans = [s for s in scan_text(f"Text before. {text} and after it", SEARCH)[2] if s.label == label]
    assert [s.errors for s in spans] == [errors]
    assert spans[0].matched == " ".join(word_text(f"Text before. {text} and after it").split()[spans[0].start:spans[0].end])


@pytest.mark.parametrize("text", ["a kit license", "it license", "the bad license", "the general public is licensed to drive", "an apache helicopter", "a driving license"])
def test_other_texts_have_no_label(text):
    assert scan_text(text, SEARCH)[2] == []


def test_overlaps_keep_the_fewest_errors():
    assert best_spans([(0, 9, "a", 2, 9), (1, 9, "a", 1, 9), (20, 29, "a", 2, 9), (0, 9, "b", 3, 9)]) == [
        (1, 9, "a", 1, 9), (20, 29, "a", 2, 9), (0, 9, "b", 3, 9)]


def test_every_match_has_a_seed():
    for notice in NOTICES:
        parts = notices.parts_of(notice)
        assert len(parts) == notice.errors + 1 and "".join(p for _, p in parts) == notice.text
        assert all(len(p) >= 4 for _, p in parts), notice


def test_odd_rows(frame):
    rows = [(1, None, 1), (2, "", 1), (3, "mit licence", 1), (3, "mit licence", 1), (None, "mit license " * 20_000, 1)]
    df = frame(rows, "doc_id long, text string, score int")
    got = sorted(((r["doc_id"], r["n_words"], len(r["places"]), len(r["spans"]), round(r["score"], 3)) for r in notices.scan_notices(df).collect()), key=str)
    assert got == sorted([(1, 0, 0, 0, 0.0), (2, 0, 0, 0, 0.0), (3, 2, 0, 1, 0.909), (3, 2, 0, 1, 0.909), (None, 40_000, 20_000, 20_000, 1.0)], key=str)
    assert notices.scan_notices(df.limit(0)).collect() == []


def test_query(spark, tmp_path):
    rows = [(1, "The MIT License, see MIT licence; GNU General Public License"), (2, None), (3, "Apache Lisense")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in queries.op11_license_notices(spark, str(tmp_path)).collect())
    assert got == [(1, 10, 2, 1, 7, "gpl,mit", "gpl,mit", 1.0), (2, 0, 0, None, None, "", "", 0.0), (3, 2, 0, None, None, "", "apache", 1 - 1 / 14)]
    assert Notice("x", "y", 0).fixed == ""

"""Template automata against plain regular expressions, and the query against its contract."""

import random
import re

import pytest

from postlens.llm import license_scan as s
from postlens.llm.license_templates import PHRASES, TEMPLATES


def _pattern(parts):
    """A regular expression over words that end in a blank."""
    out = ""
    for p in parts:
        if isinstance(p, s.Word):
            out += re.escape(p.text.decode()) + " "
        elif isinstance(p, s.AnyWords):
            out += rf"(?:\S+ ){{{p.least},{p.most}}}"
        else:
            out += f"(?:{_pattern(p.parts)})?"
    return out


def _random_parts(rng, depth=0):
    out = []
    for _ in range(rng.randint(1, 5)):
        r = rng.random()
        if r < 0.6 or depth > 1:
            out.append(s.Word(rng.choice([b"a", b"b", b"c"])))
        elif r < 0.8:
            least = rng.randint(0, 2)
            out.append(s.AnyWords(least, least + rng.randint(0, 2)))
        else:
            out.append(s.Optional(tuple(_random_parts(rng, depth + 1))))
    return out


def test_automata_against_regular_expressions():
    rng = random.Random(2)
    for _ in range(1500):
        parts = _random_parts(rng)
        words = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(0, 9))]
        fits = [n for n in range(len(words) + 1) if re.fullmatch(_pattern(parts), "".join(w.decode() + " " for w in words[:n]))]
        assert s.Automaton(parts).longest(iter(words)) == max(fits, default=-1)


def test_scan_against_search_at_every_place():
    rng = random.Random(6)
    for _ in range(400):
        parts = tuple(_random_parts(rng))
        if not any(isinstance(p, s.Word) for p in parts):
            continue
        t = s.Template("x", parts)
        words = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(1, 14))]
        found = s.Scanner([t]).scan(s.normalise(b" ".join(words)))
        head, tail = _pattern(parts[: t.anchor[0]]), _pattern(parts[t.anchor[1] :])
        want = []
        for i in range(len(words) - len(t.anchor_words) + 1):
            j = i + len(t.anchor_words)
            if words[i:j] != t.anchor_words:
                continue
            text = lambda a, b: "".join(w.decode() + " " for w in words[a:b])
            starts = [a for a in range(i + 1) if re.fullmatch(head, text(a, i))]
            stops = [b for b in range(j, len(words) + 1) if re.fullmatch(tail, text(j, b))]
            if starts and stops:
                want.append(("x", False, t.mandatory, min(starts), max(stops)))
        assert found == want


def _filled(rng, parts):
    out = []
    for p in parts:
        if isinstance(p, s.Word):
            out.append(p.text.decode())
        elif isinstance(p, s.AnyWords):
            out += [f"name{rng.randint(0, 99)}" for _ in range(rng.randint(p.least, p.most))]
        elif rng.random() < 0.5:
            out += _filled(rng, p.parts)
    return out


def test_own_templates():
    """Texts made from a template have its label; with one mandatory word changed they have not."""
    rng = random.Random(8)
    compiled = s.compile_templates(TEMPLATES, PHRASES)
    scanner = s.Scanner(compiled)
    labels = lambda text: {m[0] for m in scanner.scan(s.normalise(text.encode())) if not m[1]}
    for t in compiled:
        for _ in range(5):
            words = [rng.choice([w, w.upper(), w + ","]) for w in _filled(rng, t.parts)]
            if t.phrase:
                continue
            assert t.label in labels("before " + "\n ".join(words) + " after")
            alone = s.Scanner([t])
            changed = [s.Word(b"zzz") if i == rng.choice([k for k, p in enumerate(t.parts) if isinstance(p, s.Word)]) else p for i, p in enumerate(t.parts)]
            if changed != list(t.parts):
                assert not alone.scan(s.normalise(" ".join(_filled(rng, changed)).encode()))


def test_markup_errors():
    for bad in ("<<what>>", "<<beginOptional>> a", "a <<endOptional>>", "<<var;words=3-1>>"):
        with pytest.raises(ValueError):
            s.parse(bad)
    with pytest.raises(ValueError):
        s.Template("x", s.parse("<<var;words=0-3>>")).anchor


def test_pieces(monkeypatch):
    monkeypatch.setattr(s, "PIECE", 5)
    for text in (b"", b" ,. ", b"Aa bb  c-d\xc3\xa9f g" * 3, b"x" * 30):
        assert s.normalise(text).split() == re.findall(rb"[0-9a-z\x80-\xff]+", text.lower())
        assert s.normalise(text).count(b" ") - 1 == len(s.normalise(text).split())


def test_query_against_the_contract(spark, tmp_path):
    rng = random.Random(4)
    parts = ["MIT License", "Apache\nLicense", "general  public-license", "mit", "license", "é", "word", "Licensed under CC BY-NC 4.0.",
             "Licensed under the Apache License, Version 2.0.", "licensed under the GNU General Public License, version 3"]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))) for i in range(120)]
    rows += [(5, "MIT License"), (5, None), (None, "mit license mit license"), (200, ""), (201, ", ;"), (2**53 + 1, "x")]
    rows += [(202, "word " * 50_000 + "mit license")]
    spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, labels string, start int").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    got = s.op13_license_scan(spark, str(tmp_path)).collect()
    assert all(0 <= r.score <= 1 for r in got)
    base = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str)
    phrases = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}
    want = []
    for doc_id, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
        at = [(i, k) for k, p in phrases.items() for i in range(len(words)) if words[i : i + len(p)] == p]
        places = [i for i, _ in at] or [None]
        want.append((doc_id, len(words), len(at), min(places), max(places), ",".join(sorted({k for _, k in at}))))
    assert base == sorted(want, key=str)
    for r in got:
        mine = set(filter(None, r.labels.split(",")))
        assert mine >= set(filter(None, r.base_labels.split(","))) and r.labels == ",".join(sorted(mine))
        assert bool(mine) == (r.score > 0)
    texts = dict(rows[:120])
    assert {r.doc_id for r in got if "cc-by-nc-4.0" in r.labels} == {i for i, t in texts.items() if "BY-NC" in t}


def test_empty_table(spark):
    assert s.scan_licenses(spark.createDataFrame([], "doc_id int, text string")).count() == 0

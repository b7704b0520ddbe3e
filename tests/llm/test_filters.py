import re
from collections import Counter

import numpy as np
import pytest
from roadfeat.llm import language
from roadfeat.llm.language import PROFILE, Profiles, code_of, grams, languages
from roadfeat.llm.line_rules import base_counts, line_rules, without_lines
from roadfeat.llm.quality import STATISTICS, Discriminant, fit, quality_scores, statistics
from roadfeat.llm.queries import GOOD_FROM

ODD = [None, "", " \n\n", "!!! 123 ½", "é" * 70_000, "a b c a b c", "x\ny\nx\n\nx ", "a\x0bb\x1cc\x85d"]


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_base_counts():
    for text in [*ODD, "a b c d a b c e a b c d", "# | x #\n# | x #\n", "w " * 3000 + "v " * 3000]:
        assert base_counts((text or "").encode()) == plain_counts(text or "")


def page(i, *lines):
    return "\n".join([" ".join(f"w{i}x{j}" for j in range(60)), *lines])


def test_frequent_lines_go_and_depleted_documents_too(documents):
    common = " ".join(f"Common{j}" for j in range(80))
    rows = [(i, page(i, common.upper() if i % 2 else "  " + common), "en", "a") for i in range(12)]
    rows += [(50 + i, page(50 + i, common), "en", "b") for i in range(9)]
    rows += [(80 + i, page(7777), "en", "a") for i in range(30)]
    rows += [(200 + i, page(200 + i), "en", None) for i in range(3)]
    rows += [(300 + i, t) for i, t in enumerate(ODD)] + [(None, page(1)), (5, rows[5][1], "en", "a")]
    docs = documents(rows, "1 as line,2 as words,3 as row,4 as host")
    got = line_rules(docs).collect()
    assert len(got) == len(rows)
    want = {(d, plain_counts(t or "")) for d, t, *_ in rows}
    assert {(r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got} == want
    kept = {r.doc_id for r in got if r.kept}
    assert kept == {*range(50, 59), *range(80, 110), *range(200, 203), None}
    assert {r.doc_id for r in got if r.n_removed_words} == set(range(12))
    loose = line_rules(documents([(i, page(i, "short line"), "en", "a") for i in range(12)]))
    texts = {r.doc_id: r.text for r in without_lines(documents([(i, page(i, "short line"), "en", "a") for i in range(12)]), loose).collect()}
    assert texts == {i: page(i) for i in range(12)}


def test_languages(documents):
    words = {"aa": ["lorem", "ipsum", "dolor"], "bb": ["xyzzy", "quux", "grault"], "cc": ["ñandú", "été", "über"]}
    rows = [(i, " ".join(words[k][(i + j) % 3].upper() for j in range(1 + i % 7)), k) for i in range(150) for k in [list(words)[i % 3]]]
    rows += [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "lorem ipsum"), (2000, "lorem", None)]
    got = languages(documents(rows, "1 as gram,2 as rank")).collect()
    assert len(got) == len(rows)
    truth = {d: lang for d, _, lang, *_ in (r for r in rows if len(r) == 3)}
    assert all(r.lang_pred == truth[r.doc_id] for r in got if truth.get(r.doc_id))
    und = {1000 + i for i, t in enumerate(ODD) if not any(c.isalpha() for c in t or "")}
    assert {r.doc_id for r in got if r.lang_pred == "und"} == und
    assert all(0 <= r.score <= 1 for r in got)
    assert languages(documents([])).collect() == []
    assert [r.lang_pred for r in languages(documents([(1, "text")])).collect()] == ["und"]


def plain_grams(text):
    counts = Counter()
    for w in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        p = f"_{w}_"
        counts.update(code_of(g) for n in (1, 2, 3) for i in range(len(p) - n + 1) if (g := p[i : i + n]) != "_")
    return counts


def test_grams(monkeypatch):
    many = "".join(chr(0x4E00 + i) + " x" * (i % 2) for i in range(300))
    for chars in (1 << 18, 7):
        monkeypatch.setattr(language, "CHARS_AT_ONCE", chars)
        for text in [*ODD, many, "a", " a", "a ", "İstanbul ½ ß x_y don't", "ab ab b " * 50]:
            codes, counts = grams(text or "")
            assert codes.tolist() == sorted(codes.tolist())
            assert dict(zip(codes.tolist(), counts.tolist(), strict=True)) == plain_grams(text or "")


def test_out_of_place_distance():
    profiles = {"x": {"a": 0, "b": 1, "ab": 2}, "y": {"b": 0}}
    coded = {k: {code_of(g): r for g, r in p.items()} for k, p in profiles.items()}
    counts = plain_grams("ab ab b")
    top = sorted(counts, key=lambda g: (-counts[g], g))[:PROFILE]
    want = [sum(abs(p[g] - i) if g in p else PROFILE for i, g in enumerate(top)) for p in coded.values()]
    got, n = Profiles(coded).distances("ab ab b")
    assert got.tolist() == want and n == len(top)


def test_quality(documents, spark):
    good = lambda i: " ".join(f"word{(i * 7 + j) % 31} plain" for j in range(40)) + "."
    bad = lambda i: " ".join(f"X{(i + j) % 5}!!! |" for j in range(30 + i % 9))
    rows = [(i, bad(i) if i % 4 == 0 else good(i)) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(150)] + [(3, None, 0), (None, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int")
    docs = documents(rows + [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, good(1))], "1 as x,2 as y,3 as score")
    got = quality_scores(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert all((r.score >= GOOD_FROM) == (r.doc_id % 4 > 0) for r in got if r.doc_id is not None and r.doc_id < 200)
    assert quality_scores(documents([]), labels).collect() == []
    assert {r.score for r in quality_scores(docs, labels.limit(0)).collect()} == {0.5}


def test_discriminant_is_the_difference_of_log_densities(spark):
    rng = np.random.default_rng(1)
    d = len(STATISTICS)
    x = np.concatenate([rng.normal(0, 1, (300, d)), rng.normal(1, 2, (500, d))])
    y = np.repeat([0, 1], [300, 500])
    model = fit(spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(x, y, strict=True)], "x array<double>, y long"), 0.2, 0.1, 1.0)
    covs = [np.cov(x[y == k].T, bias=True) for k in (0, 1)]
    pooled = (300 * covs[0] + 500 * covs[1]) / 800
    logs = []
    for k in (0, 1):
        s = 0.8 * covs[k] + 0.2 * pooled + np.diag(np.diag(pooled) * 0.1 + 1e-6)
        z = x - x[y == k].mean(0)
        logs.append(np.log([300, 500][k] / 800) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(s), z))
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-9)
    assert isinstance(model, Discriminant) and len(statistics(None)) == d


def test_profiles_and_predictions_equal_plain_ones(documents):
    """Learning, ranking, distance and score of every row, from plain dictionaries."""
    import math
    import random
    import zlib

    rng = random.Random(12)
    alphabets = {"en": "abcdefghijké ", "fr": "defghijklmnop ", "Ü": "xyzäß  "}
    rows = [(i, "".join(rng.choices(alphabets[lang], k=rng.choice([0, 3, 40, 300]))), lang) for i, lang in enumerate(rng.choices(list(alphabets), k=150))]
    rows += [(900, None, "en"), (901, "123", "fr"), (902, "abc", None), (903, "de " * 60_000, "fr"), (903, "de", "fr"), (None, "ab ab", "en")]
    docs = documents(rows, "1 as gram,2 as place,3 as n")
    learned = {}
    for doc_id, text, lang in rows:
        if lang is not None and text is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5:
            counts = learned.setdefault(lang, {})
            for g, n in plain_grams(text).items():
                counts[g] = counts.get(g, 0) + n
    ranks = {lang: {g: i for i, g in enumerate(sorted(c, key=lambda g: (-c[g], g))[:PROFILE])} for lang, c in sorted(learned.items())}
    assert language.language_profiles(docs.where(~language.held_out())) == {k: v for k, v in ranks.items() if v}
    for r in languages(docs).collect():
        matching = [t for d, t, _ in rows if d == r.doc_id]
        results = []
        for text in matching:
            counts = plain_grams(text or "")
            top = sorted(counts, key=lambda g: (-counts[g], g))[:PROFILE]
            if not top:
                results.append(("und", 0.0))
                continue
            far = {lang: sum(abs(p[g] - i) if g in p else PROFILE for i, g in enumerate(top)) for lang, p in ranks.items()}
            best = min(far, key=lambda lang: (far[lang], lang))
            weights = [math.exp(-language.SHARPNESS * (d - far[best]) / (len(top) * PROFILE)) for d in far.values()]
            results.append((best, max(weights) / sum(weights)))
        assert any(r.lang_pred == lang and abs(r.score - score) < 1e-9 for lang, score in results)


def test_top_ngrams_are_limited_before_the_shuffle(spark, documents):
    import contextlib
    import io

    out = io.StringIO()
    order = language.Window.partitionBy("lang").orderBy(language.F.desc("n"), "gram")
    sums = spark.createDataFrame([("a", 1, 2)], "lang string, gram long, n long").groupBy("lang", "gram").agg(language.F.sum("n").alias("n"))
    with contextlib.redirect_stdout(out):
        sums.withColumn("place", language.F.row_number().over(order)).where(language.F.col("place") <= PROFILE).explain()
    assert "WindowGroupLimit" in out.getvalue()


def test_statistics_equal_plain_ones():
    import math

    from roadfeat.llm.quality import STATISTICS, statistics

    def plain(text):
        data = text.encode()
        words = [w for w in re.split(rb"[ \t-\r]+", data) if w]
        lines = [x for x in data.split(b"\n") if re.search(rb"[^ \t-\r]", x)]
        n, w = max(1, len(data)), max(1, len(words))
        letters = max(1, len(re.findall(rb"[A-Za-z]", data)))
        share = lambda pattern: math.sqrt(len(re.findall(pattern, data)) / n)
        return [
            math.log1p(len(words)),
            math.log1p((n - len(re.findall(rb"[ \t-\r]", data))) / w),
            math.sqrt(len(re.findall(rb"[A-Z]", data)) / letters),
            share(rb"[0-9]"),
            share(rb"!"),
            share(rb"[#*$%&|<>~^=+_@\\{}\[\]]"),
            share(rb"[.,;:'\"()\-?/`]"),
            share(rb" "),
            share(rb"[\x80-\xff]"),
            len(set(words)) / w,
            math.sqrt(1 - len(set(lines)) / max(1, len(lines))),
            math.log1p(len(words) / max(1, len(lines))),
            math.sqrt(sum(len(x) == 1 and not re.fullmatch(rb"[A-Za-z0-9]", x) for x in words) / w),
        ]

    for text in ["", " ", "A b! c1\n\nA b! c1\n", "# * x _ é 中 \t[y] {z}", "Word " * 3000, "a\x0bb\x0cc\r\nd"]:
        assert statistics(text.encode()) == pytest.approx(plain(text), abs=1e-12), (text, STATISTICS)
    assert statistics(None) == statistics(b"")

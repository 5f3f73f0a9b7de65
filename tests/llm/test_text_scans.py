"""Quality rules, license and secret scans against plain versions."""

import hashlib
import random
import re
import time

import pytest

from sluice.llm import license_scan, quality_rules, secret_scan

CLEAN = "The river ran past the old mill, and people came to see it. They stayed for hours.\n" * 1 + (
    "Every morning a boat left the quay with bread, salt and letters for the villages upstream."
)
TEXTS = [
    None, "", " ", "\n\n", "one", "a b c d e f", CLEAN, "x " * 30, ("word%d " * 12) % tuple(range(12)) + ".",
    "Home | About | Contact | Log in\n" + CLEAN, "Home | About | Contact | Help | Terms | Jobs",
    "BUY!! NOW!! CHEAP!! STUFF!! FOR!! YOU!! AND!! ALL!! YOUR!! FRIENDS!! OK!!", "a### b*** c$$$ d%%% e&&& f### g*** h$$$ i%%% j&&& k###.",
    "All rights reserved.\n" + CLEAN, "line one is here.\nline one is here.\n\nline one is here.", "é" * 100_000 + ".", "q w e r t " * 20_000,
    "nbsp is no space\x1cnor this.\tTab\x0bvt\x0cff\rcr",
]


def plain_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    marks = set()
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = {}
    for i, w in enumerate(windows):
        seen.setdefault(w, []).append(i)
    for places in seen.values():
        if len(places) > 1:
            marks |= {i + k for i in places for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(marks),
        "base_failed": len(words) < 10 or 100 * len(marks) > 20 * len(words),
    }


def test_quality_base_equals_plain_version(documents):
    rows = quality_rules.quality_rules(documents(TEXTS)).collect()
    assert [r.doc_id for r in rows] == list(range(len(TEXTS)))
    for r, text in zip(rows, TEXTS):
        assert {k: r[k] for k in plain_base(text)} == plain_base(text), text
        assert not (r.kept and r.base_failed)


def test_quality_verdicts_and_cleaning(documents):
    docs = documents(TEXTS)
    kept = {r.doc_id for r in quality_rules.quality_rules(docs).collect() if r.kept}
    assert {6, 9, 13} <= kept and not kept & {0, 1, 2, 3, 4, 5, 7, 10, 11, 12}
    out = quality_rules.cleaned_documents(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert set(texts) == kept
    assert texts[9] == (CLEAN, len(CLEAN)) and texts[13][0] == CLEAN and texts[6][0] == CLEAN


@pytest.mark.parametrize(
    "line,rule",
    [
        ("A sentence ends here.", None), ('He said "yes."', None), ("A heading", "punctuation"), ("Home | News | Sport", "navigation"),
        ("Read more", "boilerplate"), ("this is $$$ ### &&& ***", "symbols"), ("WIN!! BIG!! TODAY!!", "shouting"),
        ("It ends in a word. " * 3 + "and more", None),
    ],
)
def test_line_rules(line, rule):
    assert quality_rules.failed_rule(line, len(line.split())) == rule


def plain_license(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in license_scan.BASE_PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_base_equals_plain_version(documents):
    random.seed(5)
    bits = ["Released under the MIT License.", "apache-license, VERSION 2", "CC BY-NC", "cc by nc by nc", "under the", "mit", "license", "É", "x_y", "2.0", "ſ", "\x00", "\n"]
    texts = [*TEXTS, *(" ".join(random.choice(bits) for _ in range(random.randint(1, 12))) for _ in range(200))]
    for r, text in zip(license_scan.license_scan(documents(texts)).collect(), texts):
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_license(text), text
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert (r.score > 0) == bool(r.labels)


@pytest.mark.parametrize(
    "expression,labels,level",
    [
        ("MIT", {"mit"}, 0), ("MIT OR GPL-3.0-only", {"mit", "gpl-3"}, 0), ("MIT AND GPL-3.0-only", {"mit", "gpl-3"}, 2),
        ("GPL-2.0-only WITH Classpath-exception-2.0", {"gpl-2"}, 1), ("(MIT or Apache-2.0) and LGPL-2.1+", {"mit", "apache-2", "lgpl"}, 1),
        ("MIT or Apache-2.0 and GPL-2.0", {"mit", "apache-2", "gpl-2"}, 0), ("(MIT", None, None), ("MIT OR", None, None), (")", None, None),
        ("OR MIT", None, None), ("", None, None), ("NONE", None, None), ("MIT see the file", {"mit"}, 0), ("MIT WITH (BSD)", {"mit"}, 0),
    ],
)
def test_license_expressions(expression, labels, level):
    got = license_scan.evaluate(expression)
    assert got == (None if labels is None else (labels, level))


def test_license_tags(documents):
    texts = ["// SPDX-License-Identifier: Apache-2.0 OR MIT */\nint x;", "spdx license identifier", "# SPDX-License-Identifier: (GPL-2.0-only\ncode"]
    a, b, c = license_scan.license_scan(documents(texts)).collect()
    assert (a.labels, a.expressions, a.license_class) == ("apache-2,mit", "Apache-2.0 OR MIT", 0) and a.score > 0.9
    assert b.labels == c.labels == "" and b.score == c.score == 0 and c.expressions is None


def test_license_tags_need_known_names(documents):
    tag = "SPDX-License-Identifier: "
    texts = [f"{tag}see the file", f"{tag}GPL-2.0-only WITH nonsense", f"{tag}LicenseRef-House-1", f"{tag}MIT {tag}ISC, and more", f"{tag}MIT or\n{tag}ISC"]
    got = [(r.labels, r.expressions, r.license_class) for r in license_scan.license_scan(documents(texts)).collect()]
    assert got == [("", None, None), ("gpl-2", "GPL-2.0-only WITH nonsense", 2), ("licenseref-house-1", "LicenseRef-House-1", 3), ("isc,mit", "MIT; ISC", 0), ("isc", "ISC", 0)]


def test_license_long_text_takes_linear_time():
    text = "SPDX-License-Identifier: MIT OR Apache-2.0 under the MIT license cc by nc " * 100_000
    start = time.process_time()
    got = license_scan.scan(text)
    assert time.process_time() - start < 30
    assert got[:4] == (1_500_000, 200_000, 8, 1_499_997) and got[5] == "apache-2,cc-by-nc,mit" and got[7].count(";") == 99_999


def test_license_empty_table_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "MIT License, cc by nc", 9, "x"), (1, "MIT License, cc by nc", 9, "x"), (None, None, 1, None)], "doc_id long, text string, n_words int, labels string")
    rows = license_scan.license_scan(df).collect()
    assert [(r.doc_id, r.n_words, r.labels) for r in rows] == [(1, 5, "cc-by-nc")] * 2 + [(None, 0, "")]
    assert license_scan.license_scan(df.limit(0)).collect() == []


def plain_secrets(text):
    text, out = text or "", []
    for m in re.finditer(r"""((?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", text, re.A | re.I):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    out += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(s for *_, s in sorted(out))


def test_secret_base_equals_plain_version(documents):
    random.seed(6)
    bits = ["Token = \"abc123\"", "api_key: x", "APIKEY='abcdef'", "AKIA" + "Z9" * 8, "AKIAshort", "0123456789abcdef" * 2, "password:=", "ſecret=abcdef", "toKen=abcdef", "é", "AKIAAKIA" + "A" * 12]
    texts = [*TEXTS, *("".join(random.choice(bits) + random.choice([" ", "", "\n"]) for _ in range(random.randint(1, 8))) for _ in range(300))]
    for r, text in zip(secret_scan.secret_scan(documents(texts)).collect(), texts):
        want = plain_secrets(text)
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), text
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(want.count(f"{k}:") for k in ("assign", "access", "hex"))
        assert set(want.split(",")) <= set(r.spans.split(",")) or not want


def test_weak_parts_need_each_other():
    value, host = "wJalrXUtnFEMI7MDENGbPxRfiCYkEY42", "db.prod.example.com"
    assert secret_scan.scan(f"the value {value} alone and {host}")[1] == []
    assert secret_scan.scan("client_id = frontdesk at " + host)[1] == []
    kinds = {k for *_, k in secret_scan.scan(f"client_id = frontdesk uses {value} on {host}")[1]}
    assert kinds == {"identifier", "value", "endpoint"}
    assert secret_scan.scan(f"client_id = frontdesk\n\n{value}")[1] == []
    # Parts meet across their whole scope, unless a caller gives a reach.
    far = f"client_id = frontdesk {'x ' * 300} {value}"
    assert {k for *_, k in secret_scan.scan(far)[1]} == {"identifier", "value"} and secret_scan.scan(far, 200)[1] == []


def test_links_equal_all_pairs_of_a_scope():
    rng = random.Random(12)
    value, host = "wJalrXUtnFEMI7MDENGbPxRfiCYkEY42", "db.prod.example.com"
    bits = ["client_id = frontdesk", value, host, "AKIA" + "Z9" * 8, "token: abcdef99", "plain words", "x " * 150, "\n", "\n\n", "\n \n"]
    for _ in range(300):
        text = " ".join(rng.choice(bits) for _ in range(rng.randint(1, 14)))
        base, got = secret_scan.scan(text)
        ends = [m.start() for m in secret_scan.SCOPE_END.finditer(text)]
        scope = lambda at: sum(e <= at for e in ends)  # noqa: E731,B023
        parts = [(s, e, k) for s, e, k in base]
        parts += [(m.start(), m.end(), "identifier") for m in secret_scan.IDENTIFIER.finditer(text)]
        parts += [(m.start(), m.end(), "value") for m in re.finditer(value, text)]
        parts += [(m.start(), m.end(), "endpoint") for m in secret_scan.ENDPOINT.finditer(text)]
        near = lambda at, *kinds: any(scope(s) == scope(at) and k in kinds for s, _, k in parts)  # noqa: E731,B023
        is_id, is_secret = ("identifier", "access"), ("assign", "hex", "value")
        want = [p for p in parts if p[2] in ("assign", "access", "hex") or p[2] == "identifier" and near(p[0], *is_secret)
                or p[2] == "value" and near(p[0], *is_id) or p[2] == "endpoint" and near(p[0], *is_id) and near(p[0], *is_secret)]
        assert sorted(got) == sorted(want), text


def test_redaction_masks_every_span(documents):
    texts = [None, "", "say token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" twice", CLEAN]
    docs = documents(texts)
    out = secret_scan.redacted_documents(docs)
    rows = [(r.text, r.n_chars) for r in out.collect()]
    assert out.columns == docs.columns
    assert rows[0] == (None, None) and rows[1] == ("", 0) and rows[3] == (CLEAN, len(CLEAN))
    assert rows[2] == ('say [SECRET]" twice', 19)

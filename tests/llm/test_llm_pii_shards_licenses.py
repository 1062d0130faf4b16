"""Pseudonyms, shards and license finds against plain rules."""

import ipaddress
import re
from collections import Counter, defaultdict
from datetime import date
from itertools import product

import numpy as np
import pytest
from llm_cases import ODD_TEXTS, docs_of, no_docs, odd_docs, plain
from pyspark.sql import functions as F

from gistlet.llm import licenses, pii, sharding

SF = "/root/testdata/sf0.001"


def luhn(s):
    d = [int(c) for c in reversed(re.sub(r"\D", "", s))]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def changed(spark, texts, key=pii.TEST_KEY):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = dict(plain(pii.pseudonyms(docs, key), "doc_id", "text"))
    return [got[i] for i in range(len(texts))]


def shape(s):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", s)))


CARDS = ["4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111", "378282246310005", "3782 822463 10005"]


def test_cards_keep_form_and_check_digit(spark):
    got = changed(spark, [f"pay {c} now" for c in CARDS])
    new = [g[4:-4] for g in got]
    for c, n in zip(CARDS, new, strict=True):
        assert n != c and shape(n) == shape(c) and luhn(n)
    plain_digits = [re.sub(r"\D", "", n) for n in new]
    assert plain_digits[0] == plain_digits[1] == plain_digits[2] and plain_digits[3] == plain_digits[4]
    invalid = "no card 4111111111111112, 1234567890123"
    assert changed(spark, [invalid]) == [invalid]
    two = "4111111111111111 5500005555555559"
    a, b = changed(spark, [two])[0].split(" ")
    assert luhn(a) and luhn(b) and a == plain_digits[0] and b != "5500005555555559"


def test_values_are_linked_and_the_key_matters(spark):
    texts = ["Mail und.34@mail7.example.com", "x und.34@mail7.example.com.", "call +1 (017) 555-7713, or (017) 555-7713", "at 97.51.17.173."]
    a, b, again = changed(spark, texts), changed(spark, texts, "other"), changed(spark, texts)
    assert a == again and all(x != y for x, y in zip(a, b, strict=True))
    mail = re.search(r"\S+@\S+\.com", a[0])[0]
    assert mail in a[1] and shape(mail) == shape("und.34@mail7.example.com") and "und.34" not in mail
    phones = re.findall(r"\(\d{3}\) \d{3}-\d{4}", a[2])
    assert len(phones) == 2 and phones[0] == phones[1] != "(017) 555-7713" and a[2].startswith("call +1 (")
    ipaddress.ip_address(a[3][3:-1])
    assert "97.51.17.173" not in a[3]


def test_dates_stay_dates_of_their_form(spark):
    texts = ["2024-02-29", "29/02/2024", "29.2.2024", "02/29/2024", "1/2/2020", "01/02/2020", "1999-02-30", "2024-13-01"]
    got = changed(spark, texts)
    assert got[6:] == texts[6:]             # no dates
    y, m, d = map(int, got[0].split("-"))
    assert shape(got[0]) == "9999-99-99" and date(y, m, d) != date(2024, 2, 29)
    assert got[1] == f"{d:02}/{m:02}/{y}" and got[2] == f"{d}.{m}.{y}"
    mm, dd, yy = map(int, got[3].split("/"))
    assert date(yy, mm, dd) and dd > 12
    assert [int(x) for x in got[4].split("/")] == [int(x) for x in got[5].split("/")]


def test_date_and_number_permutations_are_one_to_one(spark):
    days = [f"{y}-{m:02}-{d:02}" for y in (1999, 2000) for m in range(1, 13) for d in range(1, 29)]
    got = changed(spark, days)
    assert len(set(got)) == len(days) and all(date.fromisoformat(g) for g in got)
    american = [f"{m:02}/{d:02}/2001" for m in range(1, 13) for d in range(13, 29)]
    assert len(set(changed(spark, american))) == len(american)
    n = spark.range(60).select(pii.permute_number(F.col("id"), 6, 10, "k", "x").alias("n"))
    assert sorted(r[0] for r in n.collect()) == list(range(60))
    codes = ["".join(p) for p in product("0123456789", repeat=3)] + ["".join(p) for p in product("ab", repeat=4)]
    rows = spark.createDataFrame([(c,) for c in codes], "c string").select("c", pii.permute_text(F.col("c"), "k", "x").alias("p"))
    out = dict(plain(rows, "c", "p"))
    assert sorted(out[c] for c in codes[:1000]) == codes[:1000]
    assert len({out[c] for c in codes[1000:]}) == 16 and all(re.fullmatch("[a-z]{4}", out[c]) for c in codes[1000:])


def test_social_security_numbers_stay_valid(spark):
    texts = [f"{a:03}-{g:02}-{s:04}" for a in (1, 665, 667, 899) for g in (1, 99) for s in (1, 9999)] + ["666-10-1000", "900-10-1000", "000-10-1000"]
    got = changed(spark, texts)
    assert got[-3:] == texts[-3:]
    for g in got[:-3]:
        assert re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", g)
    assert len(set(got)) == len(texts)


def test_clean_text_is_left_alone(spark):
    texts = ["version 1.2.3.4.5", "12 345 6789", "a@b", "1234-5678", "300.1.1.1", "x@y.z", "item 12/34/5678", "id 12345678901234567890123"]
    assert changed(spark, texts) == texts


def test_no_planted_value_survives_on_the_table(spark):
    docs = docs_of(spark, "/root/testdata/sf0.01")
    old, new = dict(plain(docs, "doc_id", "text")), dict(plain(pii.pseudonyms(docs, pii.TEST_KEY), "doc_id", "text"))
    seen = 0
    for i, t in old.items():
        for p in (r"[\w.+-]+@[\w-]+\.[\w.]+\w", r"\+\d \(\d{3}\) \d{3}-\d{4}", r"(?<![\d.])\d+\.\d+\.\d+\.\d+(?!\d)", r"(?<!\d)\d{16}(?!\d)"):
            for m in re.findall(p, t):
                if p.endswith(r"{16}(?!\d)") and not luhn(m):
                    assert m in new[i]
                else:
                    seen += 1
                    assert m not in new[i], m
        if t == new[i]:
            continue
        assert len(re.split(r"\s", t)) == len(re.split(r"\s", new[i]))
    assert seen > 30


def test_pseudonyms_of_odd_rows(spark):
    got = plain(pii.pseudonyms(odd_docs(spark), pii.TEST_KEY), "doc_id", "text")
    assert Counter(got) == Counter(plain(odd_docs(spark), "doc_id", "text"))
    assert pii.pseudonyms(no_docs(spark), pii.TEST_KEY).count() == 0
    plan = pii.pseudonyms(docs_of(spark, SF), pii.TEST_KEY)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000])
def test_feistel_is_a_permutation(n):
    got = sharding.permute(np.arange(n), n)
    assert sorted(got.tolist()) == list(range(n))
    if n == 1000:
        assert (got != sharding.permute(np.arange(n), n, key=2)).mean() > 0.9
        assert abs(np.corrcoef(got, np.arange(n))[0, 1]) < 0.15


def check_shards(docs, shards):
    rows = plain(sharding.shard(docs, shards), "doc_id", "size", "text_crc32", "shard", "slot")
    import zlib
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in plain(docs, "doc_id", "text"))
    assert Counter(r[:3] for r in rows) == want
    by = defaultdict(list)
    for *_, shard, slot in rows:
        by[shard].append(slot)
    counts = [len(by[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(by) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    return sorted(rows, key=repr)


def test_shards(spark):
    docs = docs_of(spark, SF)
    assert check_shards(docs, 24) == check_shards(docs.repartition(9, "source"), 24)
    check_shards(odd_docs(spark), 24)
    check_shards(odd_docs(spark), 5)
    copies = spark.createDataFrame([(7, "same")] * (2 * sharding.COPIES + 500) + [(i, "x") for i in range(9)], "doc_id long, text string")
    check_shards(copies, 24)
    assert sharding.shard(no_docs(spark)).count() == 0


def brute_lis(pairs):
    best = []
    for i, p in enumerate(pairs):
        best.append(1 + max((best[j] for j in range(i) if pairs[j][1] < p[1]), default=0))
    return max(best, default=0)


def test_longest_ascending_sequence():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 40):
        for _ in range(20):
            pairs = list(enumerate(rng.permutation(n).tolist()))
            got = licenses.ascending(pairs)
            assert len(got) == brute_lis(pairs)
            assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(got, got[1:], strict=False))


def test_patience_aligns_equal_words_in_order():
    rng = np.random.default_rng(5)
    template = [f"w{i % 40}" for i in range(60)]
    for _ in range(50):
        text = [w for w in template if rng.random() > 0.1]
        kept = len(text)
        for _ in range(6):
            text.insert(int(rng.integers(0, len(text))), f"x{rng.integers(100)}")
        got = licenses.patience(text, template)
        assert all(text[a] == template[b] for a, b in got)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(got, got[1:], strict=False))
        assert len(got) >= 0.85 * kept
    assert licenses.patience(template, template) == [(i, i) for i in range(60)]
    assert licenses.patience([], template) == [] == licenses.patience(["z"], template)


def test_notices_are_found_whole_and_altered(spark):
    rng = np.random.default_rng(3)
    noise = [f"the {w} under license of version software" for w in ("b", "c", "d")]
    texts, want = [], []
    for name, t in licenses.TEMPLATES.items():
        w = t.split()
        texts.append(" ".join([*noise, t, *noise]))
        want.append(name)
        if len(w) > 30:
            # any words but those that decide which license it is
            decide = {x for p in licenses.phrases(licenses.DECIDES[name].partition(" not ")[0]) for either in p for x in either}
            free = [i for i, x in enumerate(w) if not decide & set(licenses.words_of(x))]
            gone = set(rng.choice(free, len(w) // 12, replace=False).tolist())
            texts.append("\n".join([noise[0], " ".join(x for i, x in enumerate(w) if i not in gone), noise[1]]))
            want.append(name)
    texts += [" ".join(noise * 20), t + " and " + licenses.TEMPLATES["MIT"] + " " + licenses.TEMPLATES["CC-BY-NC-4.0"]]
    want += ["", ",".join(sorted({name, "MIT", "CC-BY-NC-4.0"}))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = dict(plain(licenses.licensed(licenses.scan(docs)), "doc_id", "licenses"))
    assert [got[i] for i in range(len(texts))] == want


def test_license_lines_of_the_table(spark):
    docs = docs_of(spark, "/root/testdata/sf0.01")
    got = dict(plain(licenses.licensed(licenses.scan(docs)), "doc_id", "licenses"))
    for i, t in plain(docs, "doc_id", "text"):
        want = {n for n, line in licenses.TEMPLATES.items() if len(line) < 90 and line in t}
        have = set(got[i].split(",")) - {""}
        assert want <= have and (want or not have), i


def test_licenses_of_odd_rows(spark):
    got = plain(licenses.licensed(licenses.scan(odd_docs(spark))), "doc_id", "n_finds")
    assert len(got) == len(ODD_TEXTS) + 3 and {n for _, n in got} == {0}
    assert licenses.scan(no_docs(spark)).count() == 0

import hashlib
import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import pii


def plain_base(text):
    """The base kinds by the plain patterns."""
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"[^0-9]", "", m[0])
        odd = sum(map(int, d[-1::-2])) + sum(sum(divmod(2 * int(c), 10)) for c in d[-2::-2])
        if 14 <= len(d) <= 19 and odd % 10 == 0:
            out.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet=st.sampled_from("a@.-+0123 459()é%_"), max_size=40))
def test_base_is_that_of_the_plain_patterns(text):
    assert sorted(pii.base_spans(text), key=lambda s: (s[0], pii.KINDS.index(s[2]))) == plain_base(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "192.168.0.1", "256.1.1.1", "a.b@c.de", "@x.y", "+1 (743) 555-3824", "word", "1.2.3.4.5.6.7.8", "4785380592391139", ".", "@", " ", "é"]), max_size=12))
def test_base_on_joined_parts(parts):
    for text in ("".join(parts), " ".join(parts)):
        assert sorted(pii.base_spans(text), key=lambda s: (s[0], pii.KINDS.index(s[2]))) == plain_base(text)


def test_whole_table_against_plain_patterns(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(10**6, None), (10**6 + 1, ""), (None, "mail a@b.cd"), (10**6 + 2, "x" * 3000 + "@"), (10**6 + 3, "1" * 3000), (10**6 + 3, "1" * 3000)]
    frame = spark.createDataFrame([(d, t, "s") for d, t in docs], "doc_id long, text string, spans string")
    got = {(r.doc_id, r.base_sha256): r for r in pii.report(frame).collect()}
    for doc, text in docs:
        base = plain_base(text or "")
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in base).encode()).hexdigest()
        row = got[doc, digest]
        assert [row[f"n_{k}"] for k in pii.BASE] == [sum(s[2] == k for s in base) for k in pii.BASE]
        listed = row.spans.split(",") if row.spans else []
        assert [s for s in listed if s.split(":")[0] in pii.BASE] == [f"{k}:{a}:{b}" for a, b, k in base]


def test_long_runs_take_linear_time():
    for text in ("x" * 500_000 + "@", "1" * 500_000, "1." * 250_000, "+1" * 250_000, "a@" * 250_000, "1 " * 250_000):
        pii.candidates(text)


def test_secrets_are_found_and_prose_is_not(spark):
    docs = [(i, f'call token = "{hashlib.md5(str(i).encode()).hexdigest()}" now') for i in range(30)] + [(100 + i, "the token: whatever it was, plain prose at 10:30 in 2019-20") for i in range(30)]
    rows = {r.doc_id: r.spans for r in pii.report(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(rows[i].startswith("secret:") for i in range(30))
    assert all(rows[100 + i] == "" for i in range(30))


def test_expectation_maximisation_finds_the_reliable_labeler():
    counts = {"secret|1,0,1|52": 500, "secret|-1,0,1|52": 480, "secret|-1,-1,0|52": 300, "secret|1,0,0|52": 200}
    posterior, rates = pii.reliabilities(counts)
    assert posterior["secret|1,0,1|52"] > 0.8 > 0.3 > posterior["secret|-1,-1,0|52"]
    assert rates["secret", "pattern"][0] > rates["secret", "pattern"][2]
    assert pii.reliabilities({}) == ({}, {})


def plain_extras(text):
    """The other candidates by patterns of their own: words around signs, groups of digits."""
    out = []
    names = "token|secret|password|passwd|api[-_]?key|access[-_]?key|auth"
    for m in re.finditer(rf"(?i)({names})[\"']?\s{{0,3}}[:=]\s{{0,3}}[\"']?([a-z0-9_/+.-]{{8,}})", text):
        if m.start() == 0 or not (text[m.start() - 1].isascii() and text[m.start() - 1].isalnum()):
            out.append((m.start(2), m.end(2), "secret"))
    for m in re.finditer(r"(\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}", text):
        if text[m.start() - 1 : m.start()] not in tuple("0123456789+.(-") and text[m.end() : m.end() + 1] not in tuple("0123456789-"):
            out.append((m.start(), m.end(), "local"))
    return out


def test_whole_table_candidates_and_choices(spark):
    """Every listed span of the other kinds is a plain candidate or an account number or written-out address, and every
    candidate whose key reaches the threshold is listed; the rates follow from the spans one by one.
    """
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    every = [(doc, *c) for doc, t in docs for c in pii.candidates(t)]
    for doc, t in docs:
        assert sorted(plain_extras(t)) == sorted(s for s in pii.extra_spans(t) if s[2] in ("secret", "local"))
    posterior = by_spans([c[4] for c in every])
    counts = Counter(c[4] for c in every)
    model, fitted = pii.fit(spark.createDataFrame(docs, "doc_id long, text string"))
    assert fitted.keys() == counts.keys() and all(abs(fitted[k] - posterior[k]) < 1e-4 for k in counts)
    want = {}
    for doc, a, b, kind, key in every:
        if kind in pii.BASE or pii.decide(key, model) >= pii.THRESHOLD:
            want.setdefault(doc, []).append(f"{kind}:{a}:{b}")
    got = {r.doc_id: r.spans for r in pii.report(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {d: s for d, s in got.items() if s} == {d: ",".join(s) for d, s in want.items()}
    assert any(s.startswith("secret") for spans in want.values() for s in spans)


def by_spans(keys):
    """Expectation-maximisation with a row for each span, kind by kind."""
    out = {}
    for kind in {k.split("|")[0] for k in keys}:
        own = [k for k in keys if k.split("|")[0] == kind]
        v = np.array([[int(x) for x in k.split("|")[1].split(",")] for k in own])
        p = np.clip(0.5 + 0.2 * v.sum(1), 0.05, 0.95)
        for _ in range(50):
            t, o = p.sum(), (1 - p).sum()
            odds = np.full(len(own), np.log((t + 1) / (t + o + 2) / (1 - (t + 1) / (t + o + 2))))
            for i in range(3):
                yes, no = v[:, i] == 1, v[:, i] == -1
                odds += yes * np.log(((p * yes).sum() + 1) / (t + 2) / (((1 - p) * yes).sum() + 0.1) * (o + 2))
                odds += no * np.log(((p * no).sum() + 0.1) / (t + 2) / (((1 - p) * no).sum() + 1) * (o + 2))
            new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            moved, p = np.abs(new - p).max(), new
            if moved < 1e-6:
                break
        out.update(zip(own, p.tolist()))
    return out


def test_context_is_whole_words():
    at = lambda text: (text, text.index("1.2.3.4"), text.index("1.2.3.4") + 7, "ip")
    assert pii.votes(*at("skip the hotel 1.2.3.4"))[2] == 0
    assert pii.votes(*at("the IP 1.2.3.4"))[2] == 1 == pii.votes(*at("host:1.2.3.4"))[2]
    assert pii.votes(*at("skip" + "x" * 3 + " " * 35 + " 1.2.3.4"))[2] == 0
    assert pii.words_before("sk" + "ip" + " " * 38 + "1", 42) == set()
    assert pii.words_before("sk-" + "ip" + " " * 38 + "1", 43) == {"ip"}


def test_labelers_can_say_no_of_every_kind():
    for kind, yes, no in (("email", "a.b@c.com", ".a@b.c1"), ("ip", "1.2.3.4", "01.2.3.4"), ("card", "4111111111111234", "00000000000000"), ("phone", "+1 743 555 3824", "+000 000 0000"), ("secret", "a8Z0-q9X2k", "whatever"), ("obfuscated", "a [at] b [dot] com", "a [at] b [dot] 12"), ("local", "212-555-3824", "111-111-1111"), ("number", "DE89370400440532013000", "000-00-0000")):
        assert pii.votes(yes, 0, len(yes), kind)[0] == 1 and pii.votes(no, 0, len(no), kind)[0] == -1, kind


def test_planted_spans_are_told_from_others(spark):
    """Labelled spans that the base patterns don't have: found where personal, left where not."""
    rng = random.Random(8)
    true, false = [], []
    for i in range(120):
        key = hashlib.sha256(str(i).encode()).hexdigest()
        true += [f'api_key: "{key}"', f"write to user{i} [at] mail{i} [dot] com please", f"call me, mobile {rng.randrange(212, 989)}-{rng.randrange(234, 989)}-{rng.randrange(1000, 9999)}"]
        false += ["the token: whatsoeverhappens to it", f"see example [at] section{i} [dot] 12 here", f"batch 000-{rng.randrange(100)%2}00-0000 failed"]
    docs = [(i, t) for i, t in enumerate(true + false)]
    rows = {r.doc_id: r.spans for r in pii.report(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    hit = sum(bool(rows[i]) for i in range(len(true)))
    wrong = sum(bool(rows[len(true) + i]) for i in range(len(false)))
    assert hit >= 0.95 * len(true) and wrong <= 0.05 * len(false), (hit, wrong)


def test_long_secrets_are_one_whole_span():
    for n in (8, 200, 201, 403, 100_000):
        value = ("aB3_/+.-" * n)[:n]
        assert (6, 6 + n, "secret") in pii.extra_spans(f"token={value}, and more")


def test_redaction_leaves_nothing_of_a_long_secret(spark):
    value = "".join(hashlib.sha256(str(i).encode()).hexdigest() for i in range(7))[:403]
    docs = spark.createDataFrame([(i, f'call token = "{i}{value}" now') for i in range(30)], "doc_id long, text string")
    model, _ = pii.fit(docs)
    assert {r.text for r in pii.redact(docs, model).collect()} == {'call token = "[secret]" now'}


ACCOUNTS = ["DE89370400440532013000", "FR1420041010050500013M02606", "ES9121000418450200051332", "GB29NWBK60161331926819", "IT60X0542811101000000123456", "NL91ABNA0417164300", "CH9300762011623852957", "AT611904300234573201", "BE68539007547034", "PT50000201231234567890154", "NO9386011117947"]


def test_account_numbers_of_each_listed_country():
    assert {a[:2] for a in ACCOUNTS} - {"NO"} == set(pii.ACCOUNT_LENGTHS)
    for account in ACCOUNTS:
        spaced = " ".join(account[i : i + 4] for i in range(0, len(account), 4))
        for value in (account, spaced):
            for after in ("", ".", " and so on", *(["", " AN", " IBAN X"] if account[:2] != "NO" else [])):
                assert [(a, b) for a, b, k in pii.extra_spans(f"iban {value}{after}") if k == "number"] == [(5, 5 + len(value))], (value, after)
        twice = pii.extra_spans(f"{spaced} {spaced}")
        assert account[:2] == "NO" or [(a, b) for a, b, k in twice if k == "number"] == [(0, len(spaced)), (len(spaced) + 1, 2 * len(spaced) + 1)]
    for other in ("AB12CD34EF56", "DE89 3704", "xDE89370400440532013000"):
        assert not [s for s in pii.extra_spans(other) if s[2] == "number"]


def test_redaction_leaves_nothing_of_an_account_number(spark):
    docs = spark.createDataFrame([(i, f"konto {' '.join(a[j : j + 4] for j in range(0, len(a), 4))}, danke") for i, a in enumerate(ACCOUNTS * 3)], "doc_id long, text string")
    model, _ = pii.fit(docs)
    assert not [r.text for r in pii.redact(docs, model).collect() if not re.fullmatch(r"konto (\[[a-z]+\])+, danke", r.text)]


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "a b@c.de, +1 (743) 555-3824.", 9, "k"), (2, None, None, "k"), (3, "clean", 5, None)], "doc_id long, text string, n_chars long, kind string")
    model, _ = pii.fit(docs)
    rows = sorted(map(tuple, pii.redact(docs, model).collect()))
    assert rows == [(1, "a [email], [phone].", 19, "k"), (2, None, None, "k"), (3, "clean", 5, None)]


def test_empty_table(spark):
    assert pii.report(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def plain_written_out(text):
    """Written-out addresses, piece by piece: text is cut at its signs for at and dot."""
    out, ats = [], list(re.finditer(r"(?i) *[\[(] *at *[\])] *", text))
    done = 0
    for m in ats:
        start = m.start()
        while start > 0 and re.match(r"[A-Za-z0-9._%+-]", text[start - 1]):
            start -= 1
        while start < m.start() and not (text[start].isascii() and text[start].isalnum()):
            start += 1
        end, parts = m.end(), 0
        while True:
            part = re.compile(r"[A-Za-z0-9-]+").match(text, end)
            if not part or (parts and len(part[0]) < 2):
                break
            parts, last = parts + 1, part.end()
            dot = re.compile(r"(?i) *[\[(] *dot *[\])] *").match(text, last)
            if not dot:
                break
            end = dot.end()
        if start < m.start() and parts > 1 and start >= done:
            out.append((start, last))
            done = last
    return out


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["joe", "a.b", "-", " ", "[at]", " (AT) ", "[ dot ]", "(dot)", "com", "x", "é", ".", "é "]), max_size=14))
def test_written_out_addresses_against_plain_cuts(parts):
    text = "".join(parts)
    assert [s[:2] for s in pii.extra_spans(text) if s[2] == "obfuscated"] == plain_written_out(text)


def test_written_out_addresses_have_no_longest_length(spark):
    texts = [f"mail {'x' * 65} [at] example [dot] com now", f"mail joe [at] {'d' * 70} [dot] com now", f"mail {'y' * 9000}(at){'z' * 9000}(dot){'q' * 9000} now", "mail ..joe  [ at ]  example (dot) org now"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 20)], "doc_id long, text string")
    model, _ = pii.fit(docs)
    assert {r.text for r in pii.redact(docs, model).collect()} == {"mail [obfuscated] now", "mail ..[obfuscated] now"}


def planted(seed, n=600):
    """(text, start, end, kind) with a span that is personal, and the same with one that only looks like it, as (text, None)."""
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    filler = lambda: " ".join(rng.choice(["the", "report", "says", "that", "people", "walk", "home", "late"]) for _ in range(rng.randrange(3, 12)))
    out = []
    for i in range(n):
        kind = rng.choice(["secret", "obfuscated", "local", "number"])
        true = rng.random() < 0.5
        if kind == "secret":
            value = hashlib.md5(str((seed, i)).encode()).hexdigest() if true else rng.choice(["whatever", "unknownvalue", "correcthorse", "aaaaaaaa11"])
            lead = rng.choice(["api_key = ", "token: ", 'secret="', "password="]) if true else rng.choice(["password: ", "your token = ", "example api_key = "])
        elif kind == "obfuscated":
            value = f"{rng.choice(['joe', 'ann.b'])} [at] host{rng.randrange(9)} [dot] {rng.choice(['com', 'org', 'de']) if true else rng.choice(['t1', 'xx9', '12'])}"
            lead = rng.choice(["write ", "mail ", "ask "]) if true else rng.choice(["sample ", "seen "])
        elif kind == "local":
            value = f"{rng.randrange(2, 10)}{rng.randrange(2, 10)}{rng.randrange(10)}-{rng.randrange(2, 10)}{digits(2)}-{digits(4)}" if true else f"{rng.randrange(2)}{digits(2)}-{rng.randrange(2)}{digits(2)}-{digits(4)}"
            lead = rng.choice(["call ", "phone ", "at "]) if true else rng.choice(["order ", "part ", "on "])
        else:
            value = rng.choice([f"{rng.randrange(100, 600)}-{rng.randrange(10, 99)}-{digits(4)}", f"DE{digits(20)}", f"ES{digits(22)}"]) if true else rng.choice([f"000-{rng.randrange(10, 99)}-{digits(4)}", f"ZZ{digits(20)}", f"9{digits(2)}-00-{digits(4)}"])
            lead = rng.choice(["account ", "ssn ", "of "]) if true else rng.choice(["serial ", "model ", "in "])
        text = filler() + " " + lead
        start = len(text)
        text += value + ('"' if lead.endswith('"') else "") + " " + filler()
        out.append((text, (start, start + len(value), kind) if true else None))
    return out


def test_precision_and_recall_of_planted_spans(spark):
    found = wanted = hits = 0
    for seed in (1, 2):
        rows = planted(seed)
        got = pii.report(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")).collect()
        extras = {(r.doc_id, s) for r in got for s in r.spans.split(",") if s and s.split(":")[0] in pii.EXTRA}
        true = {(i, f"{s[2]}:{s[0]}:{s[1]}") for i, (_, s) in enumerate(rows) if s}
        found, wanted, hits = found + len(extras), wanted + len(true), hits + len(extras & true)
    print(f"precision {hits / found:.3f}, recall {hits / wanted:.3f} of {wanted}")
    assert hits / found >= 0.95 and hits / wanted >= 0.95


def plain_numbers(text):
    """Numbers in groups, and accounts: two capitals, two digits, then groups of four and a shorter one, tried by length."""
    out = [(m.start(), m.end()) for m in re.finditer(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", text) if text[m.start() - 1 : m.start()] not in tuple("0123456789-") and text[m.end() : m.end() + 1] not in tuple("0123456789-")]
    word = lambda c: c != "" and c.isascii() and c.isalnum()
    at = 0
    while at < len(text):
        if not re.match(r"[A-Z]{2}[0-9]{2}", text[at : at + 4]) or (at and word(text[at - 1])):
            at += 1
            continue
        ends, place, count = [], at, 0  # every end after so many characters, a space allowed before each group of four
        while True:
            if count and count % 4 == 0 and count >= 4 and text[place : place + 1] == " " and re.match(r"[A-Z0-9]", text[place + 1 : place + 2]):
                place += 1
            if not re.match(r"[A-Z0-9]", text[place : place + 1]):
                break
            place, count = place + 1, count + 1
            if not word(text[place : place + 1]):
                ends.append((count, place))
        own = [e for n, e in ends if n == pii.ACCOUNT_LENGTHS.get(text[at : at + 2])]
        longest = [e for n, e in ends if 15 <= n <= 36]
        if own or longest:
            out.append((at, (own or longest[-1:])[0]))
            at = out[-1][1]
        else:
            at += 1
    return sorted(out)


def test_numbers_of_the_whole_table_against_plain_groups(spark):
    rows = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    rows += [t for t, _ in planted(3)] + ["ES91 2100 0418 4502 0005 1332 AND", "GB29NWBK60161331926819.", "x DE89 3704 0044 0532 0130 00 y", "AB12 3456 7890 123"]
    checked = 0
    for text in rows:
        mine = sorted(s[:2] for s in pii.extra_spans(text) if s[2] == "number")
        assert mine == plain_numbers(text), text[:200]
        checked += len(mine)
        assert [s[:2] for s in pii.extra_spans(text) if s[2] == "obfuscated"] == plain_written_out(text)
    assert checked > 100

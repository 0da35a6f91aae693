import random
import re

from voltline.llm import secret_scans as S

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(t):
    out = [("assign", *m.span()) for m in ASSIGN.finditer(t) if len(m.group(2)) >= 12]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m.group()) >= 18]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", t) if len(m.group()) >= 16]
    return sorted(out, key=lambda s: (s[1], S.KINDS[s[0]]))


def test_base_spans_match_the_patterns():
    rng = random.Random(4)
    bits = ["token", "Secret", "api_key", "APIKEY", "password", "passwd", "ſecret", "toKen", " ", "  ", "=", ":", '"', "'", "AKIA", "0123456789abcdef", "deadbeef", "ABCDEFGHIJKLMN", "x.y/z", "\n", "é"]
    for _ in range(4000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert S.base_spans(t) == brute(t), t


def literals(t):
    return [t[s:e] for k, s, e in S.scan(t)[1] if k == "literal"]


def test_lexer_reads_source_and_configuration_syntax():
    v = "Zx81!qPv#77w"
    for t in (f'db_pwd = "{v}"', f"'client_secret': '{v}'", f"authToken => `{v}`", f'export DB_PASSPHRASE="{v}"', f'privateKey := "{v}"', f"credentials: {v}"):
        assert literals(t) == [v], t


def test_constants_propagate_through_names():
    t = 'DEFAULT = "Zx81!qPv#77w"\nalias = DEFAULT\nconfig.db_password = alias\n'
    assert literals(t) == ["Zx81!qPv#77w"]
    assert literals('a = "Zx81!"\nb = "qPv#77w"\npassphrase = a + b') == ["Zx81!", "qPv#77w"]
    assert literals('a = "Zx81!qPv#77w"\nb = a\n') == []


def test_prose_and_placeholders_stay_clean():
    for t in ("note: the password is long", 'password = "changeme"', 'pwd = "${DB_PWD}"', "x == y", "https://a.org/token", "title = 'a plain title of words'", "key: value"):
        assert S.scan(t)[1] == [], t


def test_lexed_literals_inside_base_spans_are_not_added():
    base, spans = S.scan('token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"')
    assert base == spans and [s[0] for s in base] == ["assign", "hex"]


def test_mask_and_odd_rows(odd_docs, no_docs):
    assert S.mask('a token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" b') == 'a [SECRET]" b' and S.mask("plain") == "plain"
    rows = S.secret_spans(odd_docs).collect()
    assert len(rows) == odd_docs.count() and {r.spans for r in rows} == {""}
    masked = S.mask_secrets(odd_docs)
    assert masked.columns == odd_docs.columns and sorted(map(str, masked.select("doc_id", "text").collect())) == sorted(map(str, odd_docs.select("doc_id", "text").collect()))
    assert S.secret_spans(no_docs).count() == 0 and S.mask_secrets(no_docs).count() == 0


def test_many_operators_take_linear_time():
    t = "=" * 50_000 + ":" * 50_000 + 'a="b"' * 10_000
    assert S.scan(t)[1] == []


def test_constants_of_many_pieces_and_lines_are_whole():
    pieces = [f"Zx{i}!qP" for i in range(100)]
    many = "K = " + " + ".join(f'"{p}"' for p in pieces) + "\n"
    assert literals(many + "db_password = K\n") == pieces
    assert literals(many + "L = K\nclient_secret = L + K") == pieces
    steps = "a0 = \"Zx81!qPv#77w\"\n" + "".join(f'a{i} = a{i - 1} + "p{i}"\n' for i in range(1, 3000))
    assert len(literals(steps + "passphrase = a2999")) == 3000
    doubled = "b0 = \"Zx81!qPv#77w\"\n" + "".join(f"b{i} = b{i - 1} + b{i - 1}\n" for i in range(1, 60))
    assert literals(doubled + "passphrase = b59") == ["Zx81!qPv#77w"]
    for gap in ("\n", "\r\n    ", " \n\t"):
        assert literals(f'db_pwd = "Zx81!" +{gap}"qPv#77w"') == ["Zx81!", "qPv#77w"]


def test_scores_of_joined_values_are_those_of_their_text():
    rng = random.Random(6)
    bits = ["exam", "ple", "<", ">", "$", "{", "%(", "nu", "ll", "xx", "**", "*", "Zx81!", "qPv#77w", " ", "", "your", "_", "abc" * 9, "é漢", "place", "holder"]
    for _ in range(4000):
        words = [rng.choice(bits) for _ in range(rng.randint(1, 9))]
        text, at, parts = "".join(words), 0, []
        for w in words:
            parts.append((at, at + len(w)))
            at += len(w)
        k = rng.randint(0, len(parts))
        assert S.Value(text, [S.Value(text, parts[:k]), *parts[k:]]).score() == S.literal_score(text), words


def test_more_forms_of_targets_and_values():
    v = "Zx81!qPv#77w"
    long_name = "password_" + "x" * 1000
    for t in (
        f'os.environ["DB_PASSWORD"] = "{v}"', f"conf['client_secret'] = '{v}'", f'password = """{v}"""', f"pwd = \'\'\'{v}\'\'\'", f'client.set_password("{v}")',
        f'withApiKey( "{v}")', f'login(user="me", passphrase="{v}")', f'pwd = r"{v}"', f'{long_name} = "{v}"',
        f'password:\n  value: "{v}"', f'db:\n  passphrase:\n    # the one\n    first: "{v}"\n', f'"passwd": {{\n  "value": "{v}"\n}}',
    ):
        assert literals(t) == [v], t
    for t in (f'get_token("{v}")', f'other:\n  value: "{v}"', f'password:\n  a: b\nname: "{v}"', f'x["other"] = "{v}"', "passphrase:\n  note: remember\n", f'print("{v}")'):
        assert literals(t) == [], t


def test_names_may_be_given_later_and_inside_literals():
    v = "Zx81!qPv#77w"
    assert literals(f'db_pwd = LATER\nLATER = AGAIN\nAGAIN = "{v}"') == [v]
    assert literals(f'V = "{v}"\npassphrase = "${{V}}"') == [v] and literals(f'V = "{v}"\npassphrase = f"{{V}}"') == [v]
    assert literals(f'V = "{v}"\npassphrase = "pre-%(V)s"') == [v, "pre-%(V)s"]
    assert literals('pwd = "${NOT_KNOWN}"') == [] == literals("pwd = a\na = b\nb = a\n")
    assert literals(f'V = "{v}"\ndb_pwd = V\nV = "none"') == [v]  # the last one before it
    chain = "".join(f"c{i} = c{i + 1}\n" for i in range(3000)) + f'c3000 = "{v}"\npassphrase = c0'
    assert literals(chain) == [v]


def test_deep_and_long_texts_take_linear_time():
    assert S.scan("a:\n" + "".join(f"{' ' * (i % 200)}k{i}:\n" for i in range(20_000)))[1] == []
    assert S.scan("x" * 300_000 + "=1;" + "y.z" * 100_000 + ":2")[1] == []
    assert S.scan('set("' * 20_000)[1] == []


def test_added_spans_against_a_plain_reading():
    """Flat assignments of quoted literals and names: every value followed by hand."""
    rng = random.Random(8)
    names = ["host", "db_pwd", "secretKey", "a", "b", "c", "auth_token"]
    for _ in range(1500):
        lines = [(rng.choice(names), rng.choice(["Zx81!qPv#77w", "plain", "0123-abc-XYZ", "localhost"]) if rng.random() < 0.6 else None, rng.choice(names)) for _ in range(rng.randint(1, 7))]
        text, at, spans = "", 0, []
        for n, lit, ref in lines:
            text += f'{n} = "{lit}"\n' if lit else f"{n} = {ref}\n"
            spans.append((len(text) - 2 - len(lit), len(text) - 2) if lit else None)
        want = set()
        for i, (n, _, _) in enumerate(lines):
            j, seen = i, set()
            while j is not None and lines[j][1] is None and j not in seen:
                seen.add(j)
                before = [k for k in range(j) if lines[k][0] == lines[j][2]]
                after = [k for k in range(j + 1, len(lines)) if lines[k][0] == lines[j][2]]
                j = before[-1] if before else after[0] if after else None
            if j is not None and lines[j][1] and S.name_score(n) + S.literal_score(lines[j][1]) >= S.THRESHOLD:
                want.add(spans[j])
        got = [x for x in S.lexed_secrets(text) if text[x[0] - 1] == '"']
        assert set(got) == want, text

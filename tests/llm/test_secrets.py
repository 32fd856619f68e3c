import hashlib
import re
import time

import pytest

from tempestry.llm import secret_scan
from tests.llm.cases import SF, awkward, documents, empty

ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def slow(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))
    kinds = [k for _, k, _ in found]
    return kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(listed.encode()).hexdigest()


HEX = "0123456789abcdef0123456789abcdef"
ODD = [
    f"token = \"{HEX}\" TOKEN:abc def", "ſecret=abcdefgh secret=abcdefgh", "toKen=abcdefgh", "password: token: abcdef",
    "AKIA" + "A" * 15, "AKIA" + "B" * 16 + "x", "xAKIAAKIA" + "C1" * 20, HEX[:23], HEX[:24], "apikey'='a/b+c=.", "API_KEY =  x" * 3,
    "passwd=" + "a" * 100_000, "é" * 50 + "secret:" + "b" * 6, "secret=secret=token=abcdef", "password =\nabcdefg",
]


@pytest.mark.parametrize("make", [awkward, lambda s: s.read.parquet(f"{SF}/documents.parquet"), lambda s: documents(s, list(enumerate(ODD)))])
def test_base(spark, make):
    docs = make(spark)
    got = secret_scan.find_secrets(docs)
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    want = sorted(((r.doc_id, *slow(r.text)) for r in docs.collect()), key=str)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == want
    for r in got.collect():
        spans = [x.split(":") for x in r.spans.split(",") if x]
        base = ",".join(":".join(x) for x in spans if x[0] != "lexed")
        assert hashlib.sha256(base.encode()).hexdigest() == r.base_sha256
        order = [(int(a), secret_scan.KINDS.index(k), int(b)) for k, a, b in spans]
        assert order == sorted(order)


def test_no_rows(spark):
    assert secret_scan.find_secrets(empty(spark)).count() == 0


def lexed(text):
    return [text[a:b] for a, k, b in secret_scan.scan(text)[0] if k == 3]


@pytest.mark.parametrize(
    "text, want",
    [
        ('db_pwd = "hunter22x!9Qz"', ["hunter22x!9Qz"]),
        ("base = 'Zq81kd93jfLm'\nclient_credentials = base", ["Zq81kd93jfLm"]),
        ('A = "Zq81kd"; B = "93jfLm2x"; authKey = A + B', ["Zq81kd", "93jfLm2x"]),
        ('{"privateKey": "Qw3rTy7Ui8Op9As"}', ["Qw3rTy7Ui8Op9As"]),
        ("export DB_PASSPHRASE=Qw3rTy7Ui8Op", ["Qw3rTy7Ui8Op"]),
        ('colour = "Zq81kd93jfLm"\nsize: 12', []),
        ("the key to all this: patience and then some", []),
        ('author = "somebodyelse1"', []),
        ('key == "Zq81kd93jfLm"', []),
        ('password = "spaces in here do not count"', []),
        ('DB_PASS = "hunter22x!9Qz"', ["hunter22x!9Qz"]),
        ('conf["db_credential"] = "hunter22x!9Qz"', ["hunter22x!9Qz"]),
        ("os.environ['AUTH_KEY']=`Qw3rTy7Ui8Op9As`", ["Qw3rTy7Ui8Op9As"]),
        ('auth_key = "Zq81kd93" \\\n  "jfLm2xPw"', ["Zq81kd93", "jfLm2xPw"]),
        ('auth_key = ("Zq81kd93"\n  "jfLm2xPw")\nnext = "Zq81kd93x"', ["Zq81kd93", "jfLm2xPw"]),
        ('auth_key = "Zq81kd93" +\n  "jfLm2xPw"', ["Zq81kd93", "jfLm2xPw"]),
        ('auth_key = "Zq81kd93\\\njfLm2xPw"', []),  # holds white space
        ("private_key: |\n  MIIEpAIBAAKCAQEA7x\n  Qw3rTy7Ui8Op9As4Df\nname: Qw3rTy7Ui8Op9As4Df", ["MIIEpAIBAAKCAQEA7x", "Qw3rTy7Ui8Op9As4Df"]),
        ("private_key=<<'END'\nMIIEpAIBAAKCAQEA7x\nEND\nname = 'MIIEpAIBAAKCAQEA7x'", ["MIIEpAIBAAKCAQEA7x"]),
        ("<cfg><dbPwd>Qw3rTy7Ui8Op9As</dbPwd><size>Qw3rTy7Ui8Op9As</size></cfg>", ["Qw3rTy7Ui8Op9As"]),
        ('<add key="dbPwd" value="Qw3rTy7Ui8Op9As"/>', ["Qw3rTy7Ui8Op9As"]),
        ('auth_key: str = "Qw3rTy7Ui8Op9As"', ["Qw3rTy7Ui8Op9As"]),
        ('authKey = x  # "Zq81kd93jfLm"', []),
        ('size = 4  // authKey = "Zq81kd93jfLm"', ["Zq81kd93jfLm"]),
        ("authKey = None", []),
        ("authKey = config", []),
        ("authKey = configuration.production", []),
        ("privateKey: required", []),
        ('private_key = ""', []),
        ('private_key = "required"', []),
        ('private_key = "" + ""\nprivate_key_2 = private_key', []),
    ],
)
def test_assignments(text, want):
    assert lexed(text) == want


def test_base_spans_are_not_listed_twice():
    spans, base = secret_scan.scan(f'token = "{HEX}"')
    assert spans == base


def test_redaction(spark):
    docs = documents(spark, [(1, f"a token = \"{HEX}\" b"), (2, None), (3, "clean"), (None, "pwd = 'Zq81kd93jfLm' end")])
    got = secret_scan.without_secrets(docs)
    assert got.columns == docs.columns
    assert {(r.doc_id, r.text, r.n_chars) for r in got.collect()} == {
        (1, 'a [secret]" b', 13), (2, None, None), (3, "clean", 5), (None, "pwd = '[secret]' end", 20),
    }


def test_values_that_double_or_grow_line_by_line():
    text = 'secret_a = "Zq81kd93jfLm"\n' + "secret_a = secret_a + secret_a\n" * 60
    start = time.time()
    spans, _ = secret_scan.scan(text)
    assert [text[a:b] for a, _, b in spans if text[a:b].startswith("Zq")] == ["Zq81kd93jfLm"]
    text = 'v0 = "Zq81kd93jfLm"\n' + "".join(f"v{i + 1} = v{i} + 'x{i}'\n" for i in range(5000)) + "auth_key = v5000"
    spans, _ = secret_scan.scan(text)
    assert len(spans) == 5001 and time.time() - start < 20
    text = 'a = "Zq81kd93jfLm"\n' + "a = a + a + a\n" * 3000 + "auth_key = a\n" * 3000
    assert lexed(text) == ["Zq81kd93jfLm"]


def test_marks_take_no_empty_span():
    for text in ('private_key = ""', "auth_key = ''\nauth_key = ``", 'auth_key = "" "Zq81kd93jfLm9"'):
        assert all(a < b for a, _, b in secret_scan.scan(text)[0])
    assert secret_scan.redact('private_key = ""') == 'private_key = ""'

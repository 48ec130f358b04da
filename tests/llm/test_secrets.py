"""Secret scans against the plain patterns, and structures that are right or nearly right."""

import base64
import hashlib
import json
import random
import re
import struct

import pytest
from pyspark.sql import functions as F

from corpusflow.llm import queries
from corpusflow.llm.secret_scan import is_private_key, listed, of_kind, redacted, scan, spans

PATTERNS = {
    "assign": re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}
KEEPS = {
    "assign": lambda m: len(m[2]) >= 6,
    "access": lambda m: len(m[0]) >= 20,
    "hex": lambda m: len(m[0]) >= 24,
}


def brute(text):
    text = text or ""
    found = [(m.start(), i, m.end(), k) for i, k in enumerate(PATTERNS) for m in PATTERNS[k].finditer(text) if KEEPS[k](m)]
    return [(k, a, b) for a, _, b, k in sorted(found)]


# --- builders of encodings ---------------------------------------------------------------


def der(tag, value):
    n = len(value)
    if n < 0x80:
        return bytes([tag, n]) + value
    size = n.to_bytes((n.bit_length() + 7) // 8)
    return bytes([tag, 0x80 | len(size)]) + size + value


def number(n):
    return der(0x02, n.to_bytes(n.bit_length() // 8 + 1))


# Two primes of 256 bits.
P, Q = 2**256 - 189, 2**255 - 19


def rsa(p=P, q=Q):
    e = 65537
    d = pow(e, -1, (p - 1) * (q - 1)) if p != q else 3
    parts = [0, p * q, e, d, p, q, d % (p - 1), d % (q - 1), pow(q, -1, p)]
    return der(0x30, b"".join(map(number, parts)))


def wrapped(oid, key):
    return der(0x30, number(0) + der(0x30, der(0x06, bytes.fromhex(oid)) + b"\x05\x00") + der(0x04, key))


ED = wrapped("2b6570", der(0x04, bytes(range(32))))
EC = der(0x30, number(1) + der(0x04, bytes(range(1, 33))) + der(0xA0, der(0x06, bytes.fromhex("2a8648ce3d030107"))))


def openssh(cipher=b"none", check=(b"abcd", b"abcd"), kind=b"ssh-ed25519"):
    s = lambda b: struct.pack(">I", len(b)) + b
    public = s(kind) + s(bytes(32))
    secret = check[0] + check[1] + s(b"ssh-ed25519") + s(bytes(32)) + s(bytes(64)) + s(b"me") + b"\x01\x02\x03"
    return b"openssh-key-v1\0" + s(cipher) + s(b"none") + s(b"") + struct.pack(">I", 1) + s(public) + s(secret)


def pem(data, label="", width=64):
    body = base64.b64encode(data).decode()
    lines = "\n".join(body[i : i + width] for i in range(0, len(body), width))
    return f"-----BEGIN {label}PRIVATE KEY-----\n{lines}\n-----END {label}PRIVATE KEY-----"


def token(header=None, size=32, claims=None):
    enc = lambda b: base64.urlsafe_b64encode(b).decode().rstrip("=")
    header = {"alg": "HS256", "typ": "JWT"} if header is None else header
    body = json.dumps({"sub": "1"} if claims is None else claims).encode()
    return ".".join([enc(json.dumps(header).encode()), enc(body), enc(bytes(range(size)))])


# --- base patterns -----------------------------------------------------------------------


def test_base_spans_equal_the_patterns():
    r = random.Random(3)
    bits = ["password", "Token", "SECRET", "api_key", "apiKEY", "paſſword", "toKen", "=", ":", " ", "  ", '"', "'",
            "abcdef", "ab", "AKIA", "AKIA" + "Z9" * 8, "AKIA" + "Q" * 15, "0123456789abcdef" * 2, "a" * 23, "f" * 24,
            "é", "漢", "\n", "-", ".", "x", "G", "secret: token", "token: "]
    for _ in range(3000):
        text = "".join(r.choice(bits) for _ in range(r.randrange(1, 14)))
        base = [s for s in spans(text) if s[0] in PATTERNS]
        assert base == brute(text), text


def test_rejected_match_uses_up_its_text():
    assert spans("secret: token: abcdefgh") == []
    assert [s[0] for s in spans("secret; token: abcdefgh")] == ["assign"]


# --- confirmed structures ----------------------------------------------------------------

KEYS = {"rsa": rsa(), "pkcs8": wrapped("2a864886f70d010101", rsa()), "ed": ED, "ec": EC,
        "ec8": wrapped("2a8648ce3d0201", EC), "openssh": openssh()}


@pytest.mark.parametrize("name", KEYS)
def test_keys_are_found_in_every_dress(name):
    data = KEYS[name]
    assert is_private_key(data)
    plain = base64.b64encode(data).decode()
    dressed = [pem(data, "RSA "), plain, base64.b64encode(pem(data).encode()).decode()]
    dressed.append(data.hex())
    for value in dressed:
        text = f"é see {value} end"
        assert ("key", 6, 6 + len(value)) in spans(text), value
    lines = "\n".join(plain[i : i + 60] for i in range(0, len(plain), 60))
    assert any(k == "key" and text[a:b].replace("\n", "") == plain for text in [f"x\n{lines}\nword\nmore"]
               for k, a, b in spans(text))


@pytest.mark.parametrize("name", KEYS)
def test_broken_keys_are_not_reported(name):
    data = KEYS[name]
    r = random.Random(5)
    broken = [data[:-1], data + b"\0", b"\x30" + data[1:-2], bytes([data[0]]) + bytes([data[1] ^ 1]) + data[2:]]
    for value in broken:
        assert not is_private_key(value)
        assert not [s for s in spans(f"a {base64.b64encode(value).decode()} b {pem(value)}") if s[0] == "key"]
    for _ in range(200):  # no input makes the parser fail
        noise = bytearray(data)
        for _ in range(r.randrange(1, 6)):
            noise[r.randrange(len(noise))] = r.randrange(256)
        is_private_key(bytes(noise[: r.randrange(len(noise) + 1)]))


def test_key_numbers_must_fit():
    wrong = [0, P * Q + 2, 65537, 3, P, Q, 1, 1, 1]
    assert not is_private_key(der(0x30, b"".join(map(number, wrong))))
    assert not is_private_key(openssh(cipher=b"aes256-ctr"))
    assert not is_private_key(openssh(check=(b"abcd", b"abce")))
    assert not is_private_key(openssh(kind=b"ssh-rsa"))


def test_signed_tokens():
    good = token()
    assert ("token", 2, 2 + len(good)) in spans(f"x {good}.")
    assert ("token", 1, 1 + len(good)) in spans(f'"{good}"')
    again = base64.b64encode(good.encode()).decode()
    assert ("token", 0, len(again)) in spans(again)
    for bad in (token(size=31), token({"typ": "JWT"}), token({"alg": 5}), token({"alg": "none"}), token([1, 2]),
                token(claims=[1]), token({"alg": "RS256"})):
        assert not [s for s in spans(bad) if s[0] == "token"]
    assert [s for s in spans(token({"alg": "RS256"}, 256)) if s[0] == "token"]


def test_ordinary_runs_are_left_alone():
    r = random.Random(9)
    for _ in range(300):
        noise = r.randbytes(r.randrange(30, 400))
        text = f"{base64.b64encode(noise).decode()} {noise.hex().upper()} www.example.org/{'a-' * 40}"
        assert not [s for s in spans(text) if s[0] in ("key", "token")]


# --- the operator ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def texts():
    long = ("plain words go on " * 20_000) + "token=abcdef123 " + pem(ED)
    return [None, "", " ", "password: hunter22", "password: hunter22", "é AKIA" + "A" * 16, "no secret here",
            f"api_key='{'0a' * 16}'", pem(ED), token(), long]


def test_scan_and_query_columns(spark, texts):
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "token=zzzzzz", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, secrets string").withColumn("spans", F.lit(1))
    out = scan(docs).withColumns({"listing": listed(), "n": of_kind("assign")}).collect()
    assert len(out) == len(rows)
    for row in out:
        text = "token=zzzzzz" if row.doc_id is None else texts[row.doc_id]
        expected = spans(text or "")
        assert [tuple(s) for s in row.secrets] == expected
        assert row.listing == ",".join(f"{k}:{a}:{b}" for k, a, b in expected)
        assert row.n == sum(k == "assign" for k, _, _ in expected)
        assert row.spans == 1
    assert scan(docs.where("false")).count() == 0


def test_query_digest(spark, texts, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in queries.QUERIES["op13_secret_scan"](spark, str(tmp_path)).collect()}
    for i, text in rows:
        base = brute(text)
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert out[i].base_sha256 == digest
        assert (out[i].n_assign, out[i].n_access, out[i].n_hex) == tuple(
            sum(k == kind for k, _, _ in base) for kind in PATTERNS
        )
        assert out[i].spans == ",".join(f"{k}:{a}:{b}" for k, a, b in spans(text or ""))


def test_redacted(spark):
    rows = [("a token=abcdef0123456789abcdef0123 b",), ("AKIA" + "B" * 16 + "é",), ("none",), (None,)]
    found = scan(spark.createDataFrame(rows, "text string"), keep_text=True)
    out = [r[0] for r in found.select(redacted()).collect()]
    assert out == ["a [SECRET] b", "[SECRET]é", "none", None]

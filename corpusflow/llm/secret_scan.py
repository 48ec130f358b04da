"""Secrets in texts: patterns, and encodings confirmed by what they decode to.

Plain patterns (assignments, access ids, long hex numbers) are reported as they match. Runs of
base64 or hex may be anything, so they are decoded first and reported only if the bytes parse as
a private key, every nested length right, or as a token whose header names a signature of the
length that follows. Each text is judged on its own, so one pass without a shuffle does it all.

Kinds, in the order in which spans that begin alike are listed:

* ``assign``, ``access``, ``hex``: leftmost matches of the patterns that do not overlap;
* ``key``: a private key that is not encrypted (RSA, EC, DSA, PKCS #8 or OpenSSH) as PEM, or bare
  in base64 or hex, or a PEM text in base64;
* ``token``: a signed token, also one that is in base64 as a whole.

A null text has no spans and neither has an empty one. Texts of any length are scanned as a
whole, in time that grows with their length. Rows that repeat are scanned each for itself. A
column named as the result is replaced; any other stays as it is.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The kinds in order, the patterns of the first three, and their least lengths.
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "key", "token")
_ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS = r"AKIA[A-Z0-9]{16,}"
_HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6

# Anything that could be a span holds one of these; most texts hold none.
_ANY = rf"(?i:{_ASSIGN})|AKIA[A-Z0-9]{{16}}|[0-9a-f]{{24}}|[A-Za-z0-9+/_-]{{40}}|[0-9A-F]{{64}}|-----BEGIN|ey[A-Za-z0-9_-]{{8}}"

_assign = re.compile(_ASSIGN, re.IGNORECASE | re.ASCII)
_access = re.compile(_ACCESS)
_hex = re.compile(_HEX)
_pem = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40})PRIVATE KEY-----([^-]*)-----END \1PRIVATE KEY-----")
_signed = re.compile(r"(?<![A-Za-z0-9_-])(ey[A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]{16,})")
# Lines of base64 one after another count as one value.
_base64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}(?:\r?\n[A-Za-z0-9+/_-]+)*={0,2}")
_digits = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{64,}")

_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))
_SCHEMA = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("begin", T.LongType()),
            T.StructField("end", T.LongType()),
        ]
    )
)


# --- what decoded bytes must look like ----------------------------------------------------


class _Malformed(ValueError):
    pass


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int]:
    """Tag, begin and end of the value of the DER element at ``at``."""
    if at + 2 > end:
        raise _Malformed
    tag, size, at = data[at], data[at + 1], at + 2
    if size >= 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or at + n > end:
            raise _Malformed
        size = int.from_bytes(data[at : at + n])
        if size < 0x80 or size >> (8 * (n - 1)) == 0:  # DER takes the shortest form
            raise _Malformed
        at += n
    if at + size > end:
        raise _Malformed
    return tag, at, at + size


def _elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]]:
    """The elements that fill a stretch exactly."""
    found = []
    while at < end:
        found.append(_element(data, at, end))
        at = found[-1][2]
        if len(found) > 16:
            raise _Malformed
    return found


def _inside(data: bytes) -> list[tuple[int, int, int]]:
    tag, at, end = _element(data, 0, len(data))
    if tag != 0x30 or end != len(data):
        raise _Malformed
    return _elements(data, at, end)


def _numbers(data: bytes, parts: list[tuple[int, int, int]]) -> list[int]:
    return [int.from_bytes(data[a:b], signed=True) for _, a, b in parts]


# Object identifiers of key algorithms.
_RSA = bytes.fromhex("2a864886f70d010101")
_EC = bytes.fromhex("2a8648ce3d0201")
_CURVES = {bytes.fromhex("2b65") + bytes([last]): size for last, size in ((110, 32), (111, 56), (112, 32), (113, 57))}


def _is_rsa(data: bytes) -> bool:
    """Version, modulus, exponents, two primes and three helpers; the primes give the modulus."""
    parts = _inside(data)
    if [tag for tag, _, _ in parts] != [0x02] * 9:
        return False
    version, modulus, _, _, p, q, *_ = _numbers(data, parts)
    return version == 0 and modulus.bit_length() >= 256 and p > 1 and q > 1 and p * q == modulus


def _is_ec(data: bytes) -> bool:
    """Version 1, the secret number, and perhaps the curve and the public point."""
    parts = _inside(data)
    tags = [tag for tag, _, _ in parts]
    if tags[:2] != [0x02, 0x04] or tags[2:] not in ([], [0xA0], [0xA1], [0xA0, 0xA1]):
        return False
    for _, a, b in parts[2:]:
        _elements(data, a, b)
    return _numbers(data, parts[:1]) == [1] and 20 <= parts[1][2] - parts[1][1] <= 66


def _is_dsa(data: bytes) -> bool:
    """Version, prime, group order, generator, public and secret number."""
    parts = _inside(data)
    if [tag for tag, _, _ in parts] != [0x02] * 6:
        return False
    version, p, q, g, y, x = _numbers(data, parts)
    return version == 0 and q > 1 and p > q and (p - 1) % q == 0 and 0 < x < q and pow(g, x, p) == y


def _is_wrapped(data: bytes) -> bool:
    """PKCS #8: version, algorithm, and a key of that algorithm inside an octet string."""
    parts = _inside(data)
    if [tag for tag, _, _ in parts[:3]] != [0x02, 0x30, 0x04] or _numbers(data, parts[:1]) not in ([0], [1]):
        return False
    algorithm = _elements(data, *parts[1][1:])
    if not algorithm or algorithm[0][0] != 0x06:
        return False
    name, key = data[algorithm[0][1] : algorithm[0][2]], data[parts[2][1] : parts[2][2]]
    if name == _RSA:
        return _is_rsa(key)
    if name == _EC:
        return _is_ec(key)
    if name in _CURVES:
        tag, a, b = _element(key, 0, len(key))
        return tag == 0x04 and b == len(key) and b - a == _CURVES[name]
    return False


def _strings(data: bytes, at: int, n: int) -> tuple[list[bytes], int]:
    """``n`` values that a four-byte length goes before."""
    found = []
    for _ in range(n):
        size = int.from_bytes(data[at : at + 4])
        if at + 4 + size > len(data):
            raise _Malformed
        found.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return found, at


_OPENSSH = b"openssh-key-v1\0"  # fixed value


def _is_openssh(data: bytes) -> bool:
    """Cipher, derivation, its options, public keys and the secret block, which fill the bytes."""
    (cipher, _, _), at = _strings(data, len(_OPENSSH), 3)
    n = int.from_bytes(data[at : at + 4])
    if cipher != b"none" or not 1 <= n <= 16:
        return False
    (*public, secret), at = _strings(data, at + 4, n + 1)
    if at != len(data) or len(secret) < 8 or secret[:4] != secret[4:8]:
        return False
    (kind,), _ = _strings(public[0], 0, 1)
    (again,), _ = _strings(secret, 8, 1)
    return kind == again


def is_private_key(data: bytes) -> bool:
    """Whether bytes are a whole private key that is not encrypted."""
    try:
        if data.startswith(_OPENSSH):
            return _is_openssh(data)
        if data[:1] != b"\x30":
            return False
        return _is_rsa(data) or _is_wrapped(data) or _is_ec(data) or _is_dsa(data)
    except _Malformed:
        return False


# Bytes of a signature by algorithm.
_SIGNATURES = {
    **{f"HS{n}": (n // 8,) for n in (256, 384, 512)},
    **{f"{kind}{n}": (128, 256, 384, 512) for kind in ("RS", "PS") for n in (256, 384, 512)},
    "ES256": (64,),
    "ES256K": (64,),
    "ES384": (96,),
    "ES512": (132,),
    "EdDSA": (64, 114),
}


def _decoded(value: str) -> bytes:
    """Bytes of base64 in either alphabet, padded or not."""
    plain = value.rstrip("=").replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:
        raise _Malformed
    return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)


def is_signed_token(header: str, body: str, signature: str) -> bool:
    """Whether three base64 parts are a signed token: a header that names the algorithm, claims,
    and a signature of the length that the algorithm gives."""
    try:
        named, claims = json.loads(_decoded(header)), json.loads(_decoded(body))
        if not isinstance(named, dict) or not isinstance(claims, dict):
            return False
        algorithm = named.get("alg")
        return isinstance(algorithm, str) and len(_decoded(signature)) in _SIGNATURES.get(algorithm, ())
    except (ValueError, RecursionError):
        return False


# --- spans of a text ----------------------------------------------------------------------


def _pem_is_key(body: str) -> bool:
    try:
        return is_private_key(_decoded(re.sub(r"\s|\\[nr]", "", body)))
    except ValueError:
        return False


def _extent(data: bytes) -> int:
    """How many bytes the key takes that begins here."""
    if data.startswith(_OPENSSH):
        _, at = _strings(data, len(_OPENSSH), 3)
        n = int.from_bytes(data[at : at + 4])
        return _strings(data, at + 4, n + 1)[1] if n <= 16 else 0
    size, wide = data[1], data[1] & 0x7F
    if size < 0x80:
        return 2 + size
    return 2 + wide + int.from_bytes(data[2 : 2 + wide])


# How the base64 of a key, of a PEM text and of a token begins.
_BEGINNINGS = {"M": "key", base64.b64encode(_OPENSSH)[:12].decode(): "key", "LS0tLS1CRUdJTi": "pem", "ZXl": "token"}


def _confirmed_base64(found: re.Match) -> tuple[str, int] | None:
    """Kind and end of the secret that a run of base64 is, if it is one.

    Words may follow on lines of their own, so a key ends where its own lengths say, if that is
    the end of a line. Anything else is judged as a whole.
    """
    kind = next((k for b, k in _BEGINNINGS.items() if found[0].startswith(b)), None)
    if kind is None:
        return None
    lines = [(m.end(), len(m[0].rstrip("="))) for m in re.finditer(r"[^\r\n]+", found[0])]
    value = re.sub(r"[\r\n=]", "", found[0])
    try:
        if kind == "key":
            size = -(-_extent(_decoded(value[: len(value) // 4 * 4] if len(value) % 4 == 1 else value)) * 4 // 3)
            ends = dict(zip(accumulate(n for _, n in lines), (end for end, _ in lines)))
            if size not in ends:
                return None
            return ("key", ends[size]) if is_private_key(_decoded(value[:size])) else None
        data = _decoded(value)
    except ValueError:
        return None
    try:
        inner = data.decode("ascii").strip()
    except UnicodeDecodeError:
        return None
    if kind == "pem":
        match = _pem.fullmatch(inner)
        return ("key", len(found[0])) if match and _pem_is_key(match[2]) else None
    match = _signed.fullmatch(inner)
    return ("token", len(found[0])) if match and is_signed_token(*match.groups()) else None


def spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, begin and end (in code points) of every secret of a text, in order."""
    found = [("assign", *m.span()) for m in _assign.finditer(text) if len(m[2]) >= LEAST_VALUE]
    found += [("access", *m.span()) for m in _access.finditer(text)]
    found += [("hex", *m.span()) for m in _hex.finditer(text)]
    armoured = [m.span() for m in _pem.finditer(text) if _pem_is_key(m[2])]
    found += [("key", *span) for span in armoured]
    for m in _base64.finditer(text):
        if (confirmed := _confirmed_base64(m)) is not None:
            found.append((confirmed[0], m.start(), m.start() + confirmed[1]))
    for m in _digits.finditer(text):
        if len(m[0]) % 2 == 0 and is_private_key(binascii.unhexlify(m[0])):
            found.append(("key", *m.span()))
    found += [("token", *m.span()) for m in _signed.finditer(text) if is_signed_token(*m.groups())]
    bare = [  # the lines inside an armoured key are part of it
        f for f in found if f[0] != "key" or f[1:] in armoured or not any(a <= f[1] < b for a, b in armoured)
    ]
    return sorted(set(bare), key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


def scan(
    docs: DataFrame, text_col: str = "text", out_col: str = "secrets", keep_text: bool = False
) -> DataFrame:
    """Add the spans of every secret, ``array<kind, begin, end>``, in place of the text.

    ``begin`` and ``end`` count code points, the end is exclusive. A text is only looked at closely
    if a linear scan finds something that could begin a span.
    """
    gone = {out_col} if keep_text else {out_col, text_col}
    kept = [f for f in docs.schema.fields if f.name not in gone]
    schema = T.StructType([*kept, T.StructField(out_col, _SCHEMA)])
    names = [f.name for f in kept]
    spans_of = spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col)
            found: list[list] = [[] for _ in range(batch.num_rows)]
            some = pc.fill_null(pc.match_substring_regex(texts, _ANY), False)
            for i in pc.indices_nonzero(some).to_pylist():
                found[i] = [dict(zip(("kind", "begin", "end"), s)) for s in spans_of(texts[i].as_py())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(found, _TYPE)], names=[*names, out_col]
            )

    return docs.mapInArrow(run, schema)


def of_kind(kind: str, col: str = "secrets") -> Column:
    """How many spans of a kind a row has, as a long."""
    return F.size(F.filter(col, lambda s: s["kind"] == kind)).cast("long")


def listed(col: str = "secrets", kinds: tuple[str, ...] = KINDS) -> Column:
    """Spans of the kinds as ``kind:begin:end``, joined by commas."""
    wanted = F.filter(col, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(wanted, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")


def redacted(text_col: str = "text", col: str = "secrets", mark: str = "[SECRET]") -> Column:
    """The text with each stretch that spans cover, overlapping ones together, put as ``mark``.

    Needs ``scan(keep_text=True)``; a null text stays null.
    """
    start = F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at"))

    def take(done: Column, s: Column) -> Column:
        between = F.substring(F.col(text_col), (done["at"] + 1).cast("int"), (s["begin"] - done["at"]).cast("int"))
        fresh = s["begin"] >= done["at"]
        return F.struct(
            F.when(fresh, F.concat(done["text"], between, F.lit(mark))).otherwise(done["text"]).alias("text"),
            F.greatest(done["at"], s["end"]).alias("at"),
        )

    rest = F.aggregate(col, start, take)
    return F.concat(rest["text"], F.substring(F.col(text_col), (rest["at"] + 1).cast("int"), F.lit(2**31 - 1)))

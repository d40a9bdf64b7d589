"""Whole values of private keys and logins."""

import hashlib

import pytest

from spark_elt.llm import secrets


def body(owner):
    text = "".join(hashlib.sha512(f"{owner}{k}".encode()).hexdigest().upper() for k in range(4))
    return "\n".join(text[i : i + 64] for i in range(0, len(text), 64))


def block(owner, name="RSA PRIVATE KEY", headers="Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123\n\n"):
    return f"-----BEGIN {name}-----\n{headers}{body(owner)}\n-----END {name}-----"


def keys(text):
    return [(s, e, v) for s, k, e, v in secrets.find(text) if k == 6]


@pytest.mark.parametrize("name, headers", [
    ("RSA PRIVATE KEY", "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123\n\n"),
    ("PRIVATE KEY", ""),
    ("PGP PRIVATE KEY BLOCK", "Version: GnuPG v1\nComment: a - b\n\n"),
])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\\n"])
def test_key_blocks_are_whole(name, headers, end):
    key = block("a", name, headers).replace("\n", end)
    want = body("a").replace("\n", "")
    assert keys(f"x {key} y") == [(2, 2 + len(key), want)]
    cut = key[: key.index("-----END")]
    assert keys(f"x {cut}") == [(2, 2 + len(cut), want)]
    assert [v for _, _, v in keys(f"{cut}{key}")] == [want, want]
    assert keys("-----BEGIN PRIVATE KEY-----") == [(0, 27, "-----BEGIN PRIVATE KEY-----")]


def test_encrypted_keys_of_owners_differ(spark):
    data = [(i, f"s{i}", block(i)) for i in range(5)]
    got = secrets.secrets(spark.createDataFrame(data, "doc_id long, source string, text string")).collect()
    assert [(r.n_live, r.n_example) for r in got] == [(1, 0)] * 5


def test_long_logins():
    token, user = "eyJ0.x-_" * 40, "u" * 100
    assert (0, 5, len(user) + len(token) + 5, token) in secrets.find(f"://{user}:{token}@host")
    assert [h for h in secrets.find("://" + "a" * 300_000 + ":short@") if h[1] == 5] == []


def test_many_keys_take_linear_time():
    assert len(keys("-----BEGIN PRIVATE KEY-----\n" * 20_000)) == 20_000

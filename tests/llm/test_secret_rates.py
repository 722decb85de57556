"""Rates of the novelty scan: random keys found, addresses and identifiers left alone."""

from __future__ import annotations

import random
import string

import pytest

from leafcut.llm import secrets_scan

WORDS = """garden winter silver bridge morning river yellow market kitchen window forest paper summer castle letter doctor engine island mirror planet orange violin shadow
temple carpet basket ladder pencil thunder village harbor meadow candle bottle rocket saddle tunnel copper velvet walnut""".split()
ALPHABETS = {
    "letters": string.ascii_letters,
    "small": string.ascii_lowercase,
    "small and digits": string.ascii_lowercase + string.digits,
    "capitals and digits": string.ascii_uppercase + string.digits,
    "letters and digits": string.ascii_letters + string.digits,
    "base64": string.ascii_letters + string.digits + "+/",
    "base64 of addresses": string.ascii_letters + string.digits + "-_",
}


def novel(text):
    return secrets_scan.Scanner().scan(text)[4].count("novel:")


@pytest.mark.parametrize("name", ALPHABETS)
def test_random_keys_are_found(name):
    rng, scanner = random.Random(3), secrets_scan.Scanner()
    keys = ["".join(rng.choice(ALPHABETS[name]) for _ in range(rng.choice([24, 32, 40]))) for _ in range(100)]
    assert sum("novel:" in scanner.scan(f"the secret that we use is {k} and no other")[4] for k in keys) >= 97


def test_addresses_and_identifiers_are_left_alone():
    rng, scanner = random.Random(4), secrets_scan.Scanner()
    some = lambda k: [rng.choice(WORDS) for _ in range(k)]
    wrong = {"address": 0, "snake": 0, "path": 0, "kebab": 0, "dotted": 0, "constant": 0}
    for _ in range(200):
        texts = {
            "address": f"the token page https://www.{rng.choice(WORDS)}.org/{'-'.join(some(4))}/{rng.randint(10000, 99999)} is told",
            "snake": f"the secret of {'_'.join(some(4))} is told",
            "path": f"the token file is /{'/'.join(some(4))}/{rng.randint(1990, 2030)} there",
            "kebab": f"a secret named {'-'.join(some(3))}-{rng.randint(1, 99)} is told",
            "dotted": f"the session key of com.{'.'.join(some(3))}.{rng.choice(WORDS).title()} is told",
            "constant": f"the api key is in {'_'.join(some(3)).upper()} there",
        }
        for k, t in texts.items():
            wrong[k] += "novel:" in scanner.scan(t)[4]
    assert all(x <= 2 for x in wrong.values()), wrong


def test_keys_inside_addresses_and_after_words():
    key = "q7Xr2LmZ9vKp4TsWb8Yc1NdF"
    for text in (
        f"the token page https://hooks.example.org/services/T024BE7LH/{key} is told",
        f"token at https://user:{key}@example.org/",
        f"secret sk-live-{key} here",
        f"the secret store https://example.org/get?key={key} is told",
        f"token in /etc/app/keys/{key} there",
    ):
        spans = secrets_scan.Scanner().scan(text)[4].split(",")
        at = text.index(key)
        assert any(x.startswith("novel:") and int(x.split(":")[1]) <= at and int(x.split(":")[2]) >= at + len(key) for x in spans), text
    assert not novel("www.example.org/token-of-the-garden/and-of-the-river")

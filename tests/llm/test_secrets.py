"""Base spans against a plain reading of the patterns; novelty on planted strings."""

import hashlib
import random
import re
import string
import time

from docfold.llm import secrets
from docfold.llm.common import ready

ASSIGN = (
    r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])"
    r"|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))"
    "[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def brute(text):
    text = text or ""
    found = []
    for order, (kind, pattern, group, least) in enumerate(
        [("assign", ASSIGN, 2, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16)]
    ):
        at = 0
        while m := re.compile(pattern).search(text, at):
            at = m.end()
            if len(m[group]) >= least:
                found.append((m.start(), order, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def case():
    pick = random.Random(4)
    bits = ["password", "PassWD", "ſecret", "secret", "toKen", "api_key", "APIKEY", "=", " : ", '"', "'",
            "AKIA", "AKIAAKIA", "0123456789abcdef", "deadbeef", "Zz9+/", "é中😀", " ", "\n", "ABCDEFGH12", "x.y-z"]
    texts = ["".join(pick.choice(bits) for _ in range(pick.choice([1, 5, 30, 120]))) for _ in range(200)]
    texts += ["token=secret=abcdefghijkl", "password==============", "😀 apikey: 'abc.def-ghi=='", "a" * 70000]
    return [(i, t) for i, t in enumerate(texts)] + [(None, None), (7, ""), (8, texts[0]), (8, texts[0])]


def test_base_equals_brute_force(spark):
    rows = case()
    frame = ready(spark).createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, spans int")
    got = secrets.scan(frame).collect()
    want = []
    for doc_id, text in rows:
        spans = brute(text)
        sha = hashlib.sha256(",".join("%s:%d:%d" % s for s in spans).encode()).hexdigest()
        want.append((doc_id, *(sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")), sha))
    assert sorted(((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        parts = [s for s in r.spans.split(",") if s]
        assert parts == [f"{f.kind}:{f.start}:{f.end}" for f in r.found]
        assert len([p for p in parts if not p.startswith("novel")]) == r.n_assign + r.n_access + r.n_hex


def novel(text):
    return [text[a:b] for k, a, b in secrets.find(text, secrets.Novelty()) if k == "novel"]


def test_random_strings_in_sensitive_context():
    pick = random.Random(1)
    prose = "the session is opened with what the user holds and closed when the work is done "
    for size in (20, 32, 64):
        key = "".join(pick.choice(string.ascii_letters + string.digits) for _ in range(size))
        assert novel(f"{prose}\nAuthorization: Bearer {key}\n{prose}") == [key]
        assert novel(f"{prose} {key} {prose}") == []  # nothing announces it


def test_a_repeated_secret_is_found_each_time():
    pick = random.Random(6)
    for size in (20, 40, 64):
        key = "".join(pick.choice(string.ascii_letters + string.digits) for _ in range(size))
        line = f"Authorization: Bearer {key}\n"
        assert novel(line * 3) == [key] * 3
        assert novel(f"{line}signature {key[:-2]}\n") == [key, key[:-2]]


def test_a_dotted_token_is_found_whole():
    pick = random.Random(12)
    part = lambda n: "".join(pick.choice(string.ascii_letters + string.digits + "_-") for _ in range(n))
    for sizes in ((36, 74, 43), (36, 160, 43), (20, 10, 43)):
        token = ".".join(part(n) for n in sizes)
        assert novel(f"Authorization: Bearer {token}\n") == [token]
        assert novel(f"Authorization: Bearer {token}\n" * 2) == [token] * 2
    key = part(24)
    # Names before a key don't hide it, nor does a base span in the same token.
    assert key in "".join(novel(f"bearer configuration.production.authentication.service.{key} is used"))
    assert novel(f"Bearer deadbeefdeadbeef01.{key} is used") == [key]


def test_words_inside_a_token_announce_what_follows():
    pick = random.Random(9)
    key = "".join(pick.choice(string.ascii_letters + string.digits) for _ in range(40))
    assert novel(f"see x_signature={key} here") == [f"={key}"]
    assert novel(f"credential=signature={key}") == [f"={key}"]
    assert novel(f"signature.{key}") == [key]
    # A key that holds such a word by chance is found whole.
    assert f"{key}pwd{key[::-1]}" in novel(f"Authorization: Bearer {key}pwd{key[::-1]}\n")


def test_time_grows_with_the_text():
    """Long texts of announcing words, of keys and of base spans; each was quadratic once."""
    pick = random.Random(3)
    key = lambda: "".join(pick.choice(string.ascii_letters + string.digits) for _ in range(20))
    makers = [
        lambda n: "token" * (n // 5),
        lambda n: "token." * (n // 6),
        lambda n: "".join("signature" + key() for _ in range(n // 29)),
        lambda n: "".join("secret = " + key() + "\n" for _ in range(n // 30)),
        lambda n: "bearer " + "A1" * (n // 2),
    ]
    for make in makers:
        spent = []
        for size in (60_000, 960_000):
            text, start = make(size), time.process_time()
            secrets.find(text, secrets.Novelty())
            spent.append(time.process_time() - start)
        assert spent[1] < 64 * max(spent[0], 0.01), spent  # 16 times the text; squares would be 256


def test_names_are_left_alone():
    assert novel("the signature of getElementById_setTimeout_callback is known") == []
    assert novel("set the credential placeholder_your-api-key-here first") == []
    assert novel("bearer authenticationTokenProviderConfiguration") == []
    assert novel("signature aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa") == []
    copied = "Qz81hXpL0vT3mRw9KdYc"
    assert novel(f"const {copied} = load();\n// the signature {copied} is a name here") == []


def test_masking(spark):
    rows = [(1, "x token=abcdefghijklmn y", "c"), (2, None, None), (3, "", "d"), (4, "clean", "e")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, found string")
    got = secrets.mask_secrets(frame)
    assert got.columns == frame.columns
    texts = {r.doc_id: r.text for r in got.collect()}
    assert texts == {1: "x " + "*" * 20 + " y", 2: None, 3: "", 4: "clean"}


def test_empty_table(spark):
    assert secrets.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0

"""Keys in either-case hex, URL-safe and wrapped base64, and DSA keys."""

import base64

import pytest
from test_text_operators import _der, _keys

from segmint.llm import secrets


def _dsa():
    return _der(0x30, _der(2, b"\x00") + _der(2, b"\x7b\xef\xff" * 30) * 5)


@pytest.mark.parametrize("key", [*_keys(), _dsa()])
def test_keys_are_found_in_every_encoding(key):
    kind = "ssh_key" if key.startswith(b"openssh") else "der_key"
    for text in (key.hex().upper(), key.hex()[:50].upper() + key.hex()[50:]):
        assert ("hex_key", 2, 2 + len(text)) in secrets.find_secrets(f"x {text} y")
        assert "hex_key" not in {s[0] for s in secrets.find_secrets(f"x {text[:-6]} y")}
    url, body = base64.urlsafe_b64encode(key).decode(), base64.b64encode(key).decode()
    for coded in (url, url.rstrip("="), body):
        assert (kind, 2, 2 + len(coded)) in secrets.find_secrets(f"é {coded} y")
        for width, gap in ((64, "\n"), (76, "\r\n"), (32, "\n  "), (64, "\\n")):
            lines = gap.join(coded[i : i + width] for i in range(0, len(coded), width))
            for after in ("", "\nThanks for all", " end"):
                assert (kind, 4, 4 + len(lines)) in secrets.find_secrets(f"key {lines}{after}")
            assert kind not in {s[0] for s in secrets.find_secrets(f"key {lines[:-8]}\n")}
    pem = f"-----BEGIN DSA PRIVATE KEY-----\n{body}\n-----END DSA PRIVATE KEY-----"
    assert secrets.find_secrets(pem)[0] == ("pem_key", 0, len(pem))

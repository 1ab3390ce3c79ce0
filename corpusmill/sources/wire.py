"""The protobuf wire format for messages of known field numbers, for sessions without Spark's protobuf package."""

from __future__ import annotations

import struct
from collections.abc import Iterator

#: A message: field number to (name, kind, repeated); kind is text, int, float, double or a message.
Spec = dict[int, tuple[str, "str | Spec", bool]]

#: The field numbers of a deposited reaction that are read, and what numbers stand for.
_IDENTIFIER: Spec = {1: ("kind", "int", False), 3: ("value", "text", False)}
_COMPOUND: Spec = {1: ("identifiers", _IDENTIFIER, True), 3: ("role", "int", False)}
_INPUT: Spec = {1: ("key", "text", False), 2: ("value", {1: ("components", _COMPOUND, True)}, False)}
_TEMPERATURE: Spec = {1: ("temperature", {2: ("setpoint", {1: ("value", "float", False)}, False)}, False)}
REACTION: Spec = {2: ("inputs", _INPUT, True), 4: ("conditions", _TEMPERATURE, False), 8: ("outcomes", {3: ("products", {1: ("identifiers", _IDENTIFIER, True)}, True)}, True), 10: ("identifier", "text", False)}
KINDS, ROLES = {2: "SMILES"}, {1: "REACTANT"}


def _varint(buf: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = buf[at]
        at += 1
        value |= (b & 127) << shift
        if b < 128:
            return value, at
        shift += 7
        if shift > 63:
            raise ValueError("number too long")


def _fields(buf: bytes) -> Iterator[tuple[int, int, int | bytes]]:
    at = 0
    while at < len(buf):
        tag, at = _varint(buf, at)
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            value, at = _varint(buf, at)
        else:
            size = 8 if wire == 1 else 4 if wire == 5 else None
            if size is None:
                if wire != 2:
                    raise ValueError(f"wire type {wire}")
                size, at = _varint(buf, at)
            if at + size > len(buf):
                raise ValueError("cut off")
            value, at = buf[at : at + size], at + size
        yield number, wire, value


def decode(buf: bytes, spec: Spec) -> dict:
    """The message's fields by name; repeated ones are lists, fields not in the spec are skipped."""
    out: dict = {name: [] for name, _, many in spec.values() if many}
    for number, wire, value in _fields(buf):
        if number not in spec:
            continue
        name, kind, many = spec[number]
        if isinstance(kind, dict) or kind == "text":
            if wire != 2:
                raise ValueError(f"field {name} isn't a text or message")
            got = decode(value, kind) if isinstance(kind, dict) else value.decode()
        else:
            got = struct.unpack("<f" if wire == 5 else "<d", value)[0] if wire in (1, 5) else value
        if many:
            out[name].append(got)
        else:
            out[name] = got
    return out


def encode(message: dict, spec: Spec) -> bytes:
    """The wire form of a message; missing and null fields are left out."""

    def varint(n: int) -> bytes:
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        out.append(n)
        return bytes(out)

    out = b""
    for number, (name, kind, many) in sorted(spec.items()):
        value = message.get(name)
        for v in value or [] if many else [] if value is None else [value]:
            if kind == "int":
                out += varint(number << 3) + varint(v)
            elif kind in ("float", "double"):
                out += varint(number << 3 | (5 if kind == "float" else 1)) + struct.pack("<f" if kind == "float" else "<d", v)
            else:
                body = encode(v, kind) if isinstance(kind, dict) else v.encode()
                out += varint(number << 3 | 2) + varint(len(body)) + body
    return out


def reaction(blob: bytes | None) -> dict | None:
    """A deposited reaction as the readers' struct; None if it can't be decoded."""
    try:
        m = decode(blob, REACTION) if blob else None
    except (ValueError, IndexError, UnicodeDecodeError, struct.error):
        return None
    if m is None:
        return None
    named = lambda xs: [{"kind": KINDS.get(x.get("kind"), str(x.get("kind"))), "value": x.get("value")} for x in xs]
    inputs = [{"role": ROLES.get(c.get("role"), str(c.get("role"))), "identifiers": named(c["identifiers"])} for e in m["inputs"] for c in e.get("value", {}).get("components", [])]
    outcomes = [{"products": [{"identifiers": named(p["identifiers"])} for p in o["products"]]} for o in m["outcomes"]]
    return {"identifier": m.get("identifier"), "inputs": inputs, "outcomes": outcomes, "temperature": m.get("conditions", {}).get("temperature", {}).get("setpoint", {}).get("value")}

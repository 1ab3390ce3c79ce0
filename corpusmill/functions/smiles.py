"""A pure-Python molecule kernel over SMILES text.

It parses the organic subset and bracket atoms, checks valences, finds aromatic rings written in
Kekulé form, gives a canonical text by Morgan-style refinement (Weininger 1989), hashed circular
fingerprints (Rogers & Hahn 2010) and element counts. Same semantics as a chemistry toolkit for
these purposes, not bit-identical to one.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import xxhash

_TOKEN = re.compile(
    r"(?P<bracket>\[[^\[\]]+\])|(?P<atom>Br|Cl|[BCNOPSFI]|[bcnops])|(?P<ring>%\d\d|\d)|(?P<bond>[-=#$:/\\])"
    r"|(?P<open>\()|(?P<close>\))|(?P<dot>\.)|(?P<star>\*)"
)
_BRACKET = re.compile(
    r"\[(?P<iso>\d+)?(?P<el>[A-Z][a-z]?|[bcnops]|se|as|\*)(?P<chi>@{0,2})(?P<h>H\d*)?(?P<charge>\+\d|-\d|\++|-+)?(?::(?P<map>\d+))?\]"
)
#: The usual valences of the elements that may stand without brackets.
VALENCES = {"B": (3,), "C": (4,), "N": (3, 5), "O": (2,), "P": (3, 5), "S": (2, 4, 6), "F": (1,), "Cl": (1,), "Br": (1,), "I": (1,)}
_ORDER = {"": 1, "-": 1, "/": 1, "\\": 1, "=": 2, "#": 3, "$": 4, ":": 1}


@dataclass(slots=True)
class Atom:
    element: str
    aromatic: bool = False
    charge: int = 0
    hydrogens: int | None = None  # None: implicit
    isotope: int = 0
    map_no: int = 0


@dataclass(slots=True)
class Mol:
    atoms: list[Atom] = field(default_factory=list)
    bonds: list[tuple[int, int, str]] = field(default_factory=list)
    #: Of each atom, the position of its token; of each bond, that of its bond sign or -1.
    atom_at: list[int] = field(default_factory=list)
    bond_at: list[int] = field(default_factory=list)
    closures: list[int] = field(default_factory=list)
    tokens: list[str] = field(default_factory=list)

    def neighbours(self) -> list[list[tuple[int, str, int]]]:
        out: list[list[tuple[int, str, int]]] = [[] for _ in self.atoms]
        for k, (a, b, o) in enumerate(self.bonds):
            out[a].append((b, o, k))
            out[b].append((a, o, k))
        return out


def _charge(text: str | None) -> int:
    if not text:
        return 0
    sign = 1 if text[0] == "+" else -1
    return sign * (int(text[1:]) if text[1:].isdigit() else len(text))


@lru_cache(maxsize=10_000)
def _bracketed(tok: str) -> tuple | None:
    """An atom's fields out of a bracket; None if it can't be read."""
    b = _BRACKET.fullmatch(tok)
    if not b:
        return None
    el, h = b["el"], b["h"]
    return el.capitalize() if el != "*" else "*", el.islower(), _charge(b["charge"]), 0 if not h else int(h[1:] or 1), int(b["iso"] or 0), int(b["map"] or 0)


#: Unbracketed atoms as elements, and whether they are aromatic.
_PLAIN = {t: (t.capitalize() if t.islower() else t, t.islower()) for t in ("Br", "Cl", *"BCNOPSFIbcnops", "*")}


def parse(smiles: str | None) -> Mol | None:
    """The molecule, or None for null, empty or malformed text."""
    if smiles is None:
        return None
    text = smiles.strip()
    mol, stack, last, sign, sign_at = Mol(), [], None, "", -1
    rings: dict[str, tuple[int, str, int]] = {}
    at = 0
    for m in _TOKEN.finditer(text):
        if m.start() != at:
            return None
        at, kind, tok, here = m.end(), m.lastgroup, m.group(), len(mol.tokens)
        mol.tokens.append(tok)
        if kind in ("bracket", "atom", "star"):
            if kind == "bracket":
                fields = _bracketed(tok)
                if fields is None:
                    return None
                atom = Atom(*fields)
            else:
                atom = Atom(*_PLAIN[tok])
            mol.atoms.append(atom)
            mol.atom_at.append(here)
            i = len(mol.atoms) - 1
            if last is not None:
                mol.bonds.append((last, i, sign))
                mol.bond_at.append(sign_at)
            elif sign:
                return None
            last, sign, sign_at = i, "", -1
        elif kind == "ring":
            if last is None:
                return None
            if tok in rings:
                a, other, other_at = rings.pop(tok)
                if a == last:
                    return None
                mol.closures.append(len(mol.bonds))
                mol.bonds.append((a, last, sign or other))
                mol.bond_at.append(sign_at if sign else other_at)
            else:
                rings[tok] = (last, sign, sign_at)
            sign, sign_at = "", -1
        elif kind == "bond":
            if sign:
                return None
            sign, sign_at = tok, here
        elif kind == "open":
            if last is None or sign:
                return None
            stack.append(last)
        elif kind == "close":
            if not stack or sign:
                return None
            last = stack.pop()
        else:  # dot
            if sign or last is None:
                return None
            last = None
    if at != len(text) or rings or stack or sign or not mol.atoms or last is None:
        return None
    return mol


def _tree_rings(mol: Mol) -> list[list[int]]:
    """For each ring closure, the atoms on the way between its ends without other closures."""
    closing = set(mol.closures)
    adj: list[list[int]] = [[] for _ in mol.atoms]
    for k, (a, b, _) in enumerate(mol.bonds):
        if k not in closing:
            adj[a].append(b)
            adj[b].append(a)
    out = []
    for k in mol.closures:
        a, b, _ = mol.bonds[k]
        before, todo = {a: a}, [a]
        for x in todo:
            if x == b:
                break
            for y in adj[x]:
                if y not in before:
                    before[y] = x
                    todo.append(y)
        ring = [b]
        while ring[-1] != a:
            ring.append(before[ring[-1]])
        out.append(ring)
    return out


def aromatize(mol: Mol) -> set[int]:
    """Mark Kekulé rings of five or six atoms with six pi electrons aromatic; gives the bonds in them."""
    touched: set[int] = set()
    by_pair = {frozenset((a, b)): k for k, (a, b, _) in enumerate(mol.bonds)}
    for ring in _tree_rings(mol):
        if len(ring) not in (5, 6):
            continue
        inside = [by_pair.get(frozenset((ring[i], ring[i - 1]))) for i in range(len(ring))]
        if None in inside:
            continue
        doubles = [k for k in inside if mol.bonds[k][2] == "="]
        ends = [x for k in doubles for x in mol.bonds[k][:2]]
        if len(ends) != len(set(ends)):
            continue
        lone = [x for x in ring if x not in ends]
        if 2 * len(doubles) + 2 * len(lone) == 6 and all(mol.atoms[x].element in ("O", "S", "N") for x in lone) and not any(mol.atoms[x].aromatic for x in ring):
            for x in ring:
                mol.atoms[x].aromatic = True
            touched.update(inside)
    for k in touched:
        a, b, _ = mol.bonds[k]
        mol.bonds[k] = (a, b, "")
    return touched


#: Elements that take a double bond in place of a charge, and those on its other end.
_CENTRES, _ENDS = frozenset(("N", "P", "S", "Se", "As", "Cl", "Br", "I")), frozenset(("O", "S", "Se", "N", "C"))
_RAISED = {"": "=", "-": "=", "/": "=", "\\": "=", "=": "#"}


def uncharge(mol: Mol) -> list[int]:
    """Draw neighbours of opposite charge (nitro groups, N-oxides, azides, sulfoxides) with a bond of
    the next order and without the charges; gives the bonds raised."""
    raised: list[int] = []
    if not any(a.charge > 0 for a in mol.atoms):
        return raised
    for k, (a, b, o) in enumerate(mol.bonds):
        for x, y in ((mol.atoms[a], mol.atoms[b]), (mol.atoms[b], mol.atoms[a])):
            if x.charge > 0 > y.charge and x.element in _CENTRES and y.element in _ENDS and o in _RAISED and not (x.aromatic and y.aromatic):
                x.charge, y.charge = x.charge - 1, y.charge + 1
                mol.bonds[k] = (a, b, _RAISED[o])
                raised.append(k)
                break
    if raised:
        adj = mol.neighbours()
        for i in {x for k in raised for x in mol.bonds[k][:2]}:
            atom = mol.atoms[i]
            if not atom.charge and atom.hydrogens is not None and not atom.isotope and _default_h(mol, adj, i) == atom.hydrogens:
                atom.hydrogens = None
    return raised


def _atom_label(a: Atom, degree: int) -> str:
    el = a.element.lower() if a.aromatic else a.element
    h = "" if a.hydrogens is None else f"H{a.hydrogens}"
    return f"{el}{h}{a.charge:+d}{a.isotope or ''}" if (h or a.charge or a.isotope) else el


def _default_h(mol: Mol, adj, i: int) -> int | None:
    """Hydrogens that an unbracketed atom would get, or None if its valence is exceeded."""
    a = mol.atoms[i]
    if a.element not in VALENCES:
        return 0 if a.element == "*" else None
    used = sum(_ORDER[o] for _, o, _ in adj[i]) + (1 if a.aromatic else 0)
    for v in VALENCES[a.element]:
        if v + (1 if a.aromatic and a.element in ("O", "S", "N", "P") else 0) >= used:
            return max(0, v - used)
    return None


def valid(smiles: str | None) -> bool:
    """Well-formed text whose unbracketed atoms keep their valences."""
    mol = parse(smiles)
    return mol is not None and _sound(mol)


def _sound(mol: Mol) -> bool:
    adj = mol.neighbours()
    return all(a.hydrogens is not None or _default_h(mol, adj, i) is not None for i, a in enumerate(mol.atoms))


def _h(*parts) -> int:
    return xxhash.xxh3_64_intdigest("\x1f".join(map(str, parts)).encode())


@lru_cache(maxsize=10_000)
def _label_code(label: str, degree: int) -> int:
    return _h(label, degree) >> 2


_MASK, _M1, _M2 = (1 << 64) - 1, 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03


def _ranks(mol: Mol, adj) -> list[int]:
    """Morgan-style refinement: equal numbers for atoms alike in their whole surroundings. The mixing
    of 64-bit numbers is fixed, so they are the same everywhere."""
    code = [_label_code(_atom_label(a, len(adj[i])), len(adj[i])) for i, a in enumerate(mol.atoms)]
    kinds = len(set(code))
    ring = [a.aromatic for a in mol.atoms]
    near = [[(j, (5 if not o and ring[i] and ring[j] else _ORDER[o]) * _M1) for j, o, _ in adj[i]] for i in range(len(code))]
    while True:
        new = []
        for own, others in zip(code, near):
            own *= _M1
            for j, bond in others:
                x = (code[j] + bond) * _M2 & _MASK
                own += x ^ (x >> 31)
            own &= _MASK
            new.append(own ^ (own >> 29))
        code = new
        if len(set(code)) <= kinds:
            return code
        kinds = len(set(code))


def _written(a: Atom, keep_maps: bool) -> str:
    el = a.element.lower() if a.aromatic else a.element
    if a.element in VALENCES and a.hydrogens is None and not a.charge and not a.isotope and not (keep_maps and a.map_no):
        return el
    if a.element == "*" and not a.isotope and not a.charge and not (keep_maps and a.map_no):
        return "*"
    h = "" if not a.hydrogens else "H" if a.hydrogens == 1 else f"H{a.hydrogens}"
    c = "" if not a.charge else ("+" if a.charge > 0 else "-") + (str(abs(a.charge)) if abs(a.charge) > 1 else "")
    return f"[{a.isotope or ''}{el}{h}{c}{f':{a.map_no}' if keep_maps and a.map_no else ''}]"


def _write(mol: Mol, adj, code: list[int], root: int, keep_maps: bool) -> str:
    seen: dict[int, int] = {}
    opened: dict[int, list[tuple[int, str]]] = {}
    # first pass: which bonds close rings when walking in rank order
    order, closing, stack, used = [], set(), [(root, -1)], set()
    children: dict[int, list[tuple[int, str]]] = {}
    while stack:
        x, via = stack.pop()
        if x in seen:
            if via not in used:
                closing.add(via)
                used.add(via)
            continue
        seen[x] = len(order)
        order.append(x)
        if via >= 0:
            used.add(via)
            a, b, o = mol.bonds[via]
            children.setdefault(a if b == x else b, []).append((x, o))
        for j, _o, k in sorted(adj[x], key=lambda t: (code[t[0]], t[2]), reverse=True):
            if k != via and k not in used:
                stack.append((j, k))
    for n, k in enumerate(sorted(closing, key=lambda k: sorted((seen[mol.bonds[k][0]], seen[mol.bonds[k][1]])))):
        a, b, o = mol.bonds[k]
        first, then = (a, b) if seen[a] < seen[b] else (b, a)
        opened.setdefault(first, []).append((n + 1, o))
        opened.setdefault(then, []).append((n + 1, o))

    def digit(n: int) -> str:
        return str(n) if n < 10 else f"%{n}"

    def sign(o: str) -> str:
        return o if o in ("=", "#", "$") else ""

    out: list[str] = []
    todo: list = [root]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        out.append(_written(mol.atoms[x], keep_maps))
        for n, o in opened.get(x, []):
            out.append(sign(o) + digit(n))
        kids = sorted(children.get(x, []), key=lambda t: seen[t[0]])
        plan: list = []
        for i, (y, o) in enumerate(kids):
            last = i == len(kids) - 1
            plan += ([sign(o), y] if last else ["(" + sign(o), y, ")"])
        # a branch's own subtree is written before its closing bracket, so push as a nested walk
        todo.extend(reversed(plan))
    return "".join(out)


@lru_cache(maxsize=100_000)
def canonical(smiles: str | None, keep_maps: bool = False) -> str | None:
    """The same text for all drawings of a molecule; None for null or malformed text."""
    mol = parse(smiles)
    return None if mol is None else _canonical(mol, keep_maps)


def substituted(smiles: str, fragments: dict[int, str], default: str = "[H]") -> str | None:
    """The canonical structure with each attachment point replaced on the graph by the first atom of
    its label's fragment, a hydrogen by none; None where a point has not exactly one neighbour, or
    the result isn't valid."""
    mol = parse(smiles)
    if mol is None:
        return None
    for i in [k for k, a in enumerate(mol.atoms) if a.element == "*"]:
        near = [k for k, (a, b, _) in enumerate(mol.bonds) if i in (a, b)]
        frag = parse(fragments.get(mol.atoms[i].map_no, default))
        if len(near) != 1 or frag is None:
            return None
        k = near[0]
        if len(frag.atoms) == 1 and frag.atoms[0].element == "H":
            mol.atoms[i] = frag.atoms[0]
        else:
            # the fragment's first atom takes the point's place, the others come behind all atoms
            at = [i, *range(len(mol.atoms), len(mol.atoms) + len(frag.atoms) - 1)]
            mol.atoms[i] = frag.atoms[0]
            mol.atoms += frag.atoms[1:]
            mol.closures += [len(mol.bonds) + c for c in frag.closures]
            mol.bonds += [(at[a], at[b], o) for a, b, o in frag.bonds]
        mol.bonds[k] = (*mol.bonds[k][:2], "")
    bare = _without_hydrogens(mol)
    return _canonical(bare, False) if _sound(bare) else None


def _bond_of(mol: Mol, i: int) -> int:
    return next(k for k, (a, b, _) in enumerate(mol.bonds) if i in (a, b))


def _without_hydrogens(mol: Mol) -> Mol:
    """The molecule with hydrogen atoms on other atoms counted there."""
    adj = mol.neighbours()
    gone = {i for i, a in enumerate(mol.atoms) if a.element == "H" and not a.charge and not a.isotope and len(adj[i]) == 1 and mol.atoms[adj[i][0][0]].element != "H"}
    for i in gone:
        host = mol.atoms[adj[i][0][0]]
        if host.hydrogens is not None:
            host.hydrogens += 1
    adj = [[x for x in near if x[0] not in gone] for near in adj]
    for i in {a for g in gone for a in mol.bonds[_bond_of(mol, g)][:2]} - gone:
        host = mol.atoms[i]
        if host.hydrogens is not None and not host.charge and not host.isotope and _default_h(mol, adj, i) == host.hydrogens:
            host.hydrogens = None
    to = {i: n for n, i in enumerate(k for k in range(len(mol.atoms)) if k not in gone)}
    kept = [k for k, (a, b, _) in enumerate(mol.bonds) if a in to and b in to]
    closing = set(mol.closures)
    return Mol([mol.atoms[i] for i in to], [(to[mol.bonds[k][0]], to[mol.bonds[k][1]], mol.bonds[k][2]) for k in kept], closures=[n for n, k in enumerate(kept) if k in closing])


def _canonical(mol: Mol, keep_maps: bool) -> str:
    mol.bonds = [(a, b, "" if o == "-" else o) for a, b, o in mol.bonds]
    uncharge(mol)
    aromatize(mol)
    parts = []
    adj = mol.neighbours()
    code = _ranks(mol, adj)
    left = set(range(len(mol.atoms)))
    while left:
        start = min(left)
        comp, todo = {start}, [start]
        for x in todo:
            for j, _, _ in adj[x]:
                if j not in comp:
                    comp.add(j)
                    todo.append(j)
        left -= comp
        low = min(code[x] for x in comp)
        # every start among atoms alike gives a text; the smallest is kept, at most eight are tried
        parts.append(min(_write(mol, adj, code, x, keep_maps) for x in sorted(x for x in comp if code[x] == low)[:8]))
    return ".".join(sorted(parts))


def drawn_from(smiles: str, number: int) -> str:
    """Another drawing of one connected molecule: walked from atom number (modulo the atoms), with
    neighbours in an order drawn from it."""
    mol = parse(smiles)
    if mol is None:
        return smiles
    n = len(mol.atoms)
    order = [_h(number, i) for i in range(n)]
    return _write(mol, mol.neighbours(), order, number % n, True)


def formula(smiles: str | None) -> dict[str, int] | None:
    """Counts by element, hydrogens included; None for malformed text or exceeded valences."""
    mol = parse(smiles)
    return None if mol is None else _counted(mol)


def measure(smiles: str | None) -> tuple[dict[str, int], int] | None:
    """(formula, charge) from one reading; None where formula() is None."""
    mol = parse(smiles)
    counts = None if mol is None else _counted(mol)
    return None if counts is None else (counts, sum(a.charge for a in mol.atoms))


def _counted(mol: Mol) -> dict[str, int] | None:
    adj, out = mol.neighbours(), Counter()
    for i, a in enumerate(mol.atoms):
        h = a.hydrogens if a.hydrogens is not None else _default_h(mol, adj, i)
        if h is None:
            return None
        out[a.element] += 1
        if h:
            out["H"] += h
    return dict(out)


def charge(smiles: str | None) -> int | None:
    mol = parse(smiles)
    return None if mol is None else sum(a.charge for a in mol.atoms)


def heavy_atoms(smiles: str | None) -> int | None:
    mol = parse(smiles)
    return None if mol is None else sum(a.element != "H" for a in mol.atoms)


def fingerprint_bits(smiles: str | None, radius: int = 2, bits: int = 2048) -> list[int] | None:
    """Set bits of a hashed circular fingerprint, ascending."""
    mol = parse(smiles)
    if mol is None:
        return None
    uncharge(mol)
    aromatize(mol)
    adj = mol.neighbours()
    code = [_h(_atom_label(a, 0), len(adj[i])) for i, a in enumerate(mol.atoms)]
    out = {c % bits for c in code}
    for _ in range(radius):
        code = [_h(code[i], *sorted(f"{_ORDER[o]}:{code[j]}" for j, o, _ in adj[i])) for i in range(len(code))]
        out.update(c % bits for c in code)
    return sorted(out)


def tanimoto(a: list[int] | None, b: list[int] | None) -> float | None:
    """Shared over all bits; 1.0 for two empty sets, None if either is null."""
    if a is None or b is None:
        return None
    x, y = set(a), set(b)
    return 1.0 if not x and not y else len(x & y) / len(x | y)


def largest_fragment(smiles: str) -> str:
    """The part between points with the most heavy atoms, the first of equals."""
    parts = [p for p in smiles.split(".") if p]
    return max(parts, key=lambda p: heavy_atoms(p) or 0) if len(parts) > 1 else smiles


def _heavy_graph(mol: Mol) -> tuple[list[str], list[list[tuple[int, bool]]]]:
    """Elements and (neighbour, whether the bond is in a ring) of the heavy atoms."""
    ringed = {frozenset((r[i], r[i - 1])) for r in _tree_rings(mol) for i in range(len(r))}
    at = {x: i for i, x in enumerate(k for k, a in enumerate(mol.atoms) if a.element != "H")}
    near: list[list[tuple[int, bool]]] = [[] for _ in at]
    for a, b, _ in mol.bonds:
        if a in at and b in at:
            near[at[a]].append((at[b], frozenset((a, b)) in ringed))
            near[at[b]].append((at[a], frozenset((a, b)) in ringed))
    return [mol.atoms[x].element for x in at], near


def shared_fraction(a: str | None, b: str | None, enough: float = 1.0, most: int = 20_000) -> float | None:
    """Heavy atoms of a connected common substructure over those of the smaller molecule.

    Atoms match by element, bonds by being in a ring or not. The search ends as soon as enough is
    reached; below that the result only tells that enough is out of reach. None for malformed text,
    no heavy atoms, or if it is unknown after so many extensions.
    """
    p, q = parse(a), parse(b)
    if p is None or q is None:
        return None
    (ea, na), (eb, nb) = _heavy_graph(p), _heavy_graph(q)
    smaller = min(len(ea), len(eb))
    if not smaller:
        return None
    need = next(k for k in range(1, smaller + 1) if k / smaller >= enough or k == smaller)
    free_a, free_b = Counter(ea), Counter(eb)
    image: dict[int, int] = {}
    used: set[int] = set()
    banned: set[tuple[int, int]] = set()
    best, left = 0, most

    def pairs() -> list[tuple[int, int]]:
        if not image:
            return sorted(((x, y) for x in range(len(ea)) for y in range(len(eb)) if ea[x] == eb[y]), key=lambda t: (abs(len(na[t[0]]) - len(nb[t[1]])), t))
        found = {(x, y) for m, i in image.items() for x, r in na[m] if x not in image for y, t in nb[i] if t == r and y not in used and ea[x] == eb[y]}
        return sorted(found - banned, key=lambda t: (abs(len(na[t[0]]) - len(nb[t[1]])), t))

    def extend() -> bool:
        """Whether enough was reached; the pairs tried before are left out of what is tried after."""
        nonlocal best, left
        best = max(best, len(image))
        if best >= need:
            return True
        if len(image) + sum(min(n, free_b[e]) for e, n in free_a.items()) < need:
            return False
        tried = []
        for x, y in pairs():
            if left <= 0:
                break
            left -= 1
            image[x] = y
            used.add(y)
            free_a[ea[x]] -= 1
            free_b[eb[y]] -= 1
            if extend():
                return True
            del image[x]
            used.remove(y)
            free_a[ea[x]] += 1
            free_b[eb[y]] += 1
            banned.add((x, y))
            tried.append((x, y))
        banned.difference_update(tried)
        return False

    return best / smaller if extend() or left > 0 else None


def continuous(before: str, after: str, enough: float) -> float | None:
    """The larger shared fraction of the largest fragments and of the whole texts; None if unknown."""
    main = shared_fraction(largest_fragment(before), largest_fragment(after), enough)
    if main is not None and main >= enough:
        return main
    known = [x for x in (main, shared_fraction(before, after, enough)) if x is not None]
    return max(known) if known else None


#: An atom with a positive charge and one with a negative charge.
_OPPOSITE = re.compile(r"\+\d?\].*-\d?\]|-\d?\].*\+\d?\]")
_RING_OR_BRACKET = re.compile(r"\[[^\]]*\]|%\d\d|\d")
_MAPPED = re.compile(r":\d+\]")
#: A Kekulé ring's first atom is double-bonded to the next one or to the closing one, or is a heteroatom.
_MAYBE_KEKULE = re.compile(r"[CN](?:%\d\d|\d)+[=(]|=[\d%]|[NOSP](?:%\d\d|\d)+[C(]")


def plain_drawing(smiles: str) -> str:
    """One text for drawings that differ in white space, ring numbers, atom maps, Kekulé rings or
    charges of neighbours that another drawing leaves out.

    Much cheaper than canonical(); atoms keep their written order.
    """
    text = smiles.strip()
    if ":" in text:
        text = _MAPPED.sub("]", text)
    if _MAYBE_KEKULE.search(text) or _OPPOSITE.search(text):
        mol = parse(text)
        if mol is not None:
            for k in uncharge(mol):
                a, b, o = mol.bonds[k]
                for x in (a, b):
                    mol.tokens[mol.atom_at[x]] = _written(mol.atoms[x], False)
                if mol.bond_at[k] >= 0:
                    mol.tokens[mol.bond_at[k]] = o
                elif k not in mol.closures:
                    mol.tokens[mol.atom_at[b]] = o + mol.tokens[mol.atom_at[b]]
            inside = aromatize(mol)
            for k in inside:
                if mol.bond_at[k] >= 0:
                    mol.tokens[mol.bond_at[k]] = ""
                for x in mol.bonds[k][:2]:
                    tok = mol.tokens[mol.atom_at[x]]
                    if tok[0] not in "[=#":
                        mol.tokens[mol.atom_at[x]] = tok.lower()
            text = "".join(mol.tokens)
    taken: dict[str, int] = {}

    def number(m: re.Match) -> str:
        tok = m.group()
        if tok[0] == "[":
            return tok
        if tok in taken:
            n = taken.pop(tok)
        else:
            n = 1
            while n in taken.values():
                n += 1
            taken[tok] = n
        return str(n) if n < 10 else f"%{n}"

    return _RING_OR_BRACKET.sub(number, text)

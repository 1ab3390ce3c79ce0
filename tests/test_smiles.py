import random

import pytest

from corpusmill.functions import smiles as S

SAMPLES = ["CCO", "O=C(C(OC)CCC(CC)CN(C)COCc1ccnc(CCOC)c1)Cl", "[Li]CCOCCCCNC(=O)CCOc1csc(C#N)c1", "C1CC2CCC1CC2", "[O-][N+](=O)c1ccccc1", "C1CC1CC1CC1", "OC(=O)C#CC=CC", "c1ccc2ccccc2c1", "CS(=O)(=O)OCC"]


@pytest.mark.parametrize("text", SAMPLES)
def test_canonical_is_the_same_for_all_drawings(text):
    want = S.canonical(text)
    assert S.canonical(want) == want
    for k in range(40):
        drawn = S.drawn_from(text, k)
        assert S.canonical(drawn) == want and S.formula(drawn) == S.formula(text)
        assert S.fingerprint_bits(drawn) == S.fingerprint_bits(text)


def test_different_molecules_differ():
    assert len({S.canonical(x) for x in [*SAMPLES, "CCCO", "CC(C)O", "COC", "C1CCCCC1", "C=CO", "CC=O"]}) == len(SAMPLES) + 6


@pytest.mark.parametrize(("a", "b"), [("c1ccccc1C", "C2=CC=CC=C2C"), ("c1csc(Br)c1", "C1=CSC(Br)=C1"), ("c1ccnc(C(=O)OC)c1", " C4=CC=NC(C(=O)OC)=C4"), ("CC1CC1C", "CC%12CC%12C"), ("[CH3:1]C", "[CH3]C"), ("c1ccoc1", "O1C=CC=C1")])
def test_plain_drawing(a, b):
    if "o" in a:
        assert S.canonical(a) == S.canonical(b)
    else:
        assert S.plain_drawing(a) == S.plain_drawing(b)


@pytest.mark.parametrize(
    ("a", "b"),
    [("CC[N+](=O)[O-]", "CCN(=O)=O"), ("[O-][N+](=O)c1ccccc1", "O=N(=O)C1=CC=CC=C1"), ("C[N+]([O-])=O", "CN(=O)=O"), ("CN=[N+]=[N-]", "CN=N#N"), ("C[N-][N+]#N", "CN=N#N"), ("C[S+]([O-])C", "CS(=O)C"), ("c1cc[n+]([O-])cc1", "c1ccn(=O)cc1"), ("C[P+](C)(C)[CH-]C", "CP(C)(C)=CC")],
)
def test_charges_that_another_drawing_leaves_out(a, b):
    assert S.plain_drawing(a) == S.plain_drawing(b) and S.canonical(a) == S.canonical(b) and S.valid(b)
    assert S.fingerprint_bits(a) == S.fingerprint_bits(b) and S.charge(a) == S.charge(b) == 0


def test_charges_apart_stay():
    for t in ("[O-]c1ccccc1[N+](C)(C)C", "[O-]C", "C[N+](C)(C)C", "[Na+].[Cl-]"):
        assert S.plain_drawing(t) == t and S.canonical(t) != S.canonical(t.replace("+", "").replace("-", ""))


def test_plain_drawing_keeps_other_rings():
    assert S.plain_drawing("O=C1CCC(C=CC)CC1") == "O=C1CCC(C=CC)CC1"
    assert S.plain_drawing("C3CC3CC3CC3") == "C1CC1CC1CC1"


@pytest.mark.parametrize("bad", [None, "", "C(", "C)", "C1CC", "C==C", "Xy", "[C", "C(C)(C)(C)(C)C", "F(C)C", "(C)", "C=", ".C", "C..C"])
def test_malformed(bad):
    assert not S.valid(bad)


def test_numbers():
    assert S.formula("CCO") == {"C": 2, "H": 6, "O": 1} and S.formula("c1ccccc1") == {"C": 6, "H": 6}
    assert S.charge("[NH4+].[Cl-]") == 0 and S.charge("[O-]C") == -1 and S.heavy_atoms("CCN(CC)CC") == 7
    assert S.tanimoto([], []) == 1.0 and S.tanimoto(None, [1]) is None and S.tanimoto([1, 2], [2, 3]) == 1 / 3


def test_random_text_never_crashes():
    rng = random.Random(0)
    for _ in range(3000):
        t = "".join(rng.choice("CNO()=#1234[]+-cnHBrl.%/:* ") for _ in range(rng.randrange(14)))
        S.valid(t), S.canonical(t), S.plain_drawing(t), S.formula(t)


def test_shared_fraction():
    assert S.shared_fraction("CCO", "OCC") == 1.0 and S.shared_fraction("CCCC", "NNNN") == 0.0
    assert S.shared_fraction("C1CCCCC1", "CCCCCC") == 1 / 6  # ring bonds match ring bonds only
    assert S.shared_fraction("?", "CC") is None and S.shared_fraction("[H][H]", "CC") is None
    assert S.shared_fraction("CCN(CC)CC", "CCNCC", 0.5) >= 0.5
    assert S.shared_fraction("CC(C)CCCOCCC(O)C", "CCCCCCCCC(O)O", 1.0, 50) is None
    assert S.continuous("CCCCCC.BrC(Br)(Br)Br", "CCCCCCO.BrC(Br)(Br)Br", 0.9) == 1.0


def test_substitution_on_the_graph():
    put = S.substituted
    assert put("C([*:1])=O", {1: "CC"}) == S.canonical("CCC=O") and put("[*:1]C(=O)[*:2]", {1: "c1ccccc1", 2: "OC"}) == S.canonical("COC(=O)c1ccccc1")
    assert put("C1CC([*:1])C%12CC1C%12", {1: "C1CC1"}) == S.canonical("C1CC(C2CC2)C3CC1C3") and put("c1ccc([*:1])cc1", {1: "c1ccccc1"}) == S.canonical("c1ccc(-c2ccccc2)cc1")
    assert put("C[N-][*:1]", {1: "C"}) == S.canonical("C[N-]C") and put("[13CH2]([*:1])C", {1: "Cl"}) == S.canonical("[13CH2](Cl)C")
    assert put("C([*:1])=O", {}) == put("C([*:1])=O", {1: "[H]"}) == S.canonical("C=O") and put("C[NH][*:1]", {}) == S.canonical("CN")
    assert put("[*:1]", {1: "C"}) is None and put("C[*:1]C", {1: "C"}) is None and put("C(=O)(=O)[*:1]", {1: "C"}) is None and put("C(", {}) is None
    twice = S.canonical("c1ccc(-c2ccccc2)cc1")
    assert S.canonical(twice) == twice == S.canonical("c1ccc(c2ccccc2)cc1")

"""Typed names of organisations and people: what they consist of, and how alike two of them are.

A name is split into its common words, which many owners share (what the organisation does, its form, a direction), and its core,
the words that tell owners apart; people have a given name besides. Which words are common, and how much each of them tells, is
learned from all names (``Vocabulary.learned``): a word in one name of a hundred or more is common, and tells the less the
more names have it. A short list of general words stands in where there are too few names to learn from. Words are compared by
edit similarity, and as almost equal if one abbreviates the other; lists of words by Monge-Elkan similarity, weighted by what
the words tell.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

# Legal forms, credentials and fillers, which never tell anything, and short forms of given names.
LEGAL = "ASSN CO COMPANY CORP CORPORATION INC INCORPORATED LIMITED LLC LLP LP LTD PA PARTNERSHIP PC PLC PLLC PROF PROFESSIONAL".split()
CREDENTIALS = "APRN ARNP BCBA DDS DMD DO DPM DR ESQ FNP JR LCSW LMFT LMHC LMSW LPC LPCC MD NP PHD PMHNP PSYD RN".split()
FILLERS = "AND AT BY FOR IN OF ON OR THE".split()
NICKNAMES = {
    "ALEXANDER": "AL", "ALEXANDRA": "ALEX SANDRA", "ANTHONY": "TONY", "BENJAMIN": "BEN", "CATHERINE": "CATHY", "CHARLES": "CHARLIE CHUCK",
    "CHRISTOPHER": "CHRIS", "DANIEL": "DAN DANNY", "DAVID": "DAVE", "DEBORAH": "DEB DEBBIE DEBRA", "DONALD": "DON", "EDWARD": "ED EDDIE TED",
    "ELIZABETH": "BESS BETH BETSY BETTY ELIZA LIZ LIZZIE", "GREGORY": "GREG", "JAMES": "JAMIE JIM JIMMY", "JENNIFER": "JEN JENNY", "JOHN": "JACK JOHNNY",
    "JOSEPH": "JOE JOEY", "JOSEPHINE": "JO JOSIE", "KATHERINE": "KAT KATE KATHY KATIE", "KENNETH": "KEN", "LAWRENCE": "LARRY LAURIE",
    "MARGARET": "MAGGIE MEG PEG PEGGY", "MATTHEW": "MATT", "MICHAEL": "MICK MIKE MIKEY", "NATHANIEL": "NAT NATE NATHAN", "NICHOLAS": "NICK",
    "PATRICIA": "PAT PATTY TRISH", "RICHARD": "DICK RICH RICK RICKY", "ROBERT": "BOB BOBBY ROB ROBBIE", "RONALD": "RON", "SAMUEL": "SAM",
    "STEPHEN": "STEVE", "SUSAN": "SUE SUSIE SUZY", "THOMAS": "TOM TOMMY", "TIMOTHY": "TIM", "VICTORIA": "TORI VICKI VICKY", "WILLIAM": "BILL BILLY WILL",
}
# General words in names of health organisations, for what there are too few names to learn from.
SPECIALTIES = (
    "ADDICTION ALLERGY ANESTHESIA AUTISM BEHAVIORAL BIRTH CANCER CARDIAC CARDIOLOGY CARDIOVASCULAR CHILD CHILDRENS CHIROPRACTIC COMMUNITY COSMETIC COUNSELING"
    " DENTAL DENTISTRY DERMATOLOGY DIABETES DIAGNOSTIC DIALYSIS EMERGENCY ENDOCRINOLOGY EYE FAMILY FERTILITY FOOT GASTROENTEROLOGY GERIATRIC GYNECOLOGY HAND HEARING"
    " HEART HEMATOLOGY HOME HOSPICE IMAGING INFUSION INTERNAL KIDNEY LASER MATERNITY MENTAL NEPHROLOGY NEUROLOGY NEUROSURGERY NURSING NUTRITION OBSTETRICS OCCUPATIONAL"
    " ONCOLOGY OPHTHALMOLOGY OPTICAL OPTOMETRY ORAL ORTHODONTICS ORTHOPEDIC OTOLARYNGOLOGY PAIN PATHOLOGY PEDIATRIC PHARMACY PHYSICAL PLASTIC PODIATRY PRIMARY PSYCHIATRY"
    " PSYCHOLOGY PULMONARY RADIOLOGY RECOVERY REHABILITATION RENAL REPRODUCTIVE RESPIRATORY RHEUMATOLOGY SENIOR SKIN SLEEP SPEECH SPINE SPORTS SURGICAL THORACIC TRAUMA"
    " URGENT UROLOGY VASCULAR VEIN VISION WELLNESS WOMENS WOUND"
).split()
GENERAL = (
    "AGENCY ASSOCIATES CARE CENTER CLINIC CONSULTANTS DOCTORS FOUNDATION GROUP HEALTH HEALTHCARE HOSPITAL INSTITUTE LABORATORY MANAGEMENT MEDICAL MEDICINE NETWORK"
    " PARTNERS PHYSICIANS PRACTICE PROGRAM PROVIDERS SERVICES SOLUTIONS SPECIALISTS SUPPORT SURGERY SYSTEM THERAPY TREATMENT"
).split()
PLACES = "CENTRAL EAST GREATER LOWER NEW NORTH SAINT SOUTH UPPER WEST".split()

GIVEN = {n: full for full, nicks in NICKNAMES.items() for n in [full, *nicks.split()]}
DROPPED = {*LEGAL, *CREDENTIALS, *FILLERS}
EXPECTED = {**dict.fromkeys(SPECIALTIES, 0.02), **dict.fromkeys([*GENERAL, *PLACES], 0.08)}  # share of names with a word, before any are seen
LONG_CORE = 13
TELLS = 0.05  # a word in more of the names tells too little to stand for an owner's trade alone
NOISE = re.compile(r"\bD\s*/?\s*B\s*/?\s*A\b.*|\bC/O\b.*|\([^)]*\)|#\s*\d+|\bSITE\s+\w?\d+|-?\s*\bMAIN\s+OFFICE\b")
LOOKALIKE = str.maketrans("015", "OLS")


def osa(a: str, b: str, most: int) -> int:
    """Edits (insert, delete, replace, swap neighbours) between two words; ``most + 1`` if there are more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


def abbreviates(short: str, word: str) -> bool:
    """Same first letter, the others in order; a plural s may stand at the end."""
    if len(short) >= 4 and short[-1] == "S" and word[-1] != "S":
        short = short[:-1]
    if len(short) < 2 or len(short) >= len(word) or short[0] != word[0]:
        return False
    rest = iter(word[1:])
    return all(c in rest for c in short[1:])


def words(name: str) -> list[str]:
    s = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode().upper()
    s = NOISE.sub(" ", s)
    s = re.sub(r"\b([A-Z])\.(?=[A-Z]\b)", r"\1", s)
    out = [w.translate(LOOKALIKE) for w in re.findall(r"[A-Z0-9]+", s.replace("'", "")) if not w.isdigit()]
    joined: list[str] = []
    i = 0
    while i < len(out):  # P L L C
        n = next((n for n in (4, 3, 2) if i + n <= len(out) and all(len(w) == 1 for w in out[i : i + n]) and "".join(out[i : i + n]) in DROPPED), 1)
        joined.append("".join(out[i : i + n]))
        i += n
    return joined


@dataclass(frozen=True)
class Name:
    kind: str  # 'org' or 'person'
    core: tuple[str, ...]
    descriptor: tuple[str, ...] = ()
    given: str = ""

    def text(self) -> str:
        return "|".join((self.kind, " ".join(self.core), " ".join(self.descriptor), self.given))

    @classmethod
    def of(cls, text: str) -> Name:
        kind, core, descriptor, given = text.split("|")
        return cls(kind, tuple(core.split()), tuple(descriptor.split()), given)


def one_way(a: tuple[str, ...], b: tuple[str, ...], alike: Callable[[str, str], float], weight: Callable[[str], float] = lambda w: 1.0) -> float:
    """Each word's best partner in ``b``, weighted mean."""
    return sum(weight(p) * max(alike(p, q) for q in b) for p in a) / sum(map(weight, a)) if a and b else 0.0


def monge_elkan(a: tuple[str, ...], b: tuple[str, ...], alike: Callable[[str, str], float], weight: Callable[[str], float] = lambda w: 1.0) -> float:
    """The lower of both directions."""
    return min(one_way(a, b, alike, weight), one_way(b, a, alike, weight))


def alike_core(a: str, b: str) -> float:
    """0 to 1: a core word may have one edit, or two if it is long, or another word glued to it: names of different owners differ
    in little more."""
    if a == b:
        return 1.0
    short, word = sorted((a, b), key=len)
    if len(short) >= 6 and word.startswith(short):
        return 0.9
    most = 2 if len(word) >= LONG_CORE and a[0] == b[0] else 1
    d = osa(short, word, most)
    return 1 - d / len(word) if d <= most else 0.0


def same_core(a: tuple[str, ...], b: tuple[str, ...], least: float = 0.78) -> bool:
    """Monge-Elkan similarity of the cores."""
    return monge_elkan(a, b, alike_core) >= least


class Cache(dict):
    """Results of a function of words; forgets all when full."""

    def __init__(self, f: Callable, most: int = 1 << 18) -> None:
        super().__init__()
        self.f, self.most = f, most

    def __call__(self, *key):
        key = key[0] if len(key) == 1 else key
        if key not in self:
            if len(self) >= self.most:
                self.clear()
            self[key] = self.f(*key) if isinstance(key, tuple) else self.f(key)
        return self[key]


class Vocabulary:
    """The common words of names, and how much each tells."""

    def __init__(self, share: Mapping[str, float] | None = None) -> None:
        self.share = dict(sorted((EXPECTED if share is None else share).items(), key=lambda x: (-x[1], x[0])))
        self.by_first: dict[str, list[str]] = {}
        for w in self.share:
            self.by_first.setdefault(w[0], []).append(w)
        # endings that another word may be glued to: a common word or, from five letters on, its beginning
        self.endings = {w[:k]: w for w in reversed(self.share) if w not in PLACES for k in range(min(len(w), 5), len(w) + 1) if len(w) >= 4}
        self.describing, self.glued = Cache(self._describing), Cache(self._glued)
        self.alike, self.weight, self.may_tell, self.parse = Cache(self._alike), Cache(self._weight), Cache(self._may_tell), Cache(self._parse)

    def __reduce__(self) -> tuple:
        return Vocabulary, (self.share,)

    @classmethod
    def learned(cls, counts: Mapping[str, int], n: int, least: float = 0.01, fewest: int = 20, prior: int = 200) -> Vocabulary:
        """From the number of names with each word, among ``n`` names. Words in a share of ``least`` of the names, and in ``fewest``
        at least, are common, unless they abbreviate or misspell a more common one. The general words count as seen in
        ``prior`` further names; where there are ten times as many real ones, those that hardly occur are left out."""
        common: dict[str, float] = {}
        for w in sorted({*counts, *EXPECTED}, key=lambda w: (-counts.get(w, 0), w)):
            seen = counts.get(w, 0)
            often = seen >= max(fewest, least * n) and len(w) > 1 and not w.isdigit() and w not in GIVEN and w not in DROPPED
            if often and w not in EXPECTED:
                often = not any(c[0] == w[0] and (abbreviates(w, c) or (len(c) >= 6 and osa(w, c, 1) <= 1)) for c in common)
            if often or (w in EXPECTED and (n < 10 * prior or seen >= least * n / 10)):
                common[w] = (seen + prior * EXPECTED.get(w, least)) / (n + prior)
        return cls(common)

    def _describing(self, word: str) -> str | None:
        """The common word that ``word`` is, misspells or abbreviates."""
        if word in self.share:
            return word
        some = self.by_first.get(word[0], [])
        letters = set(word)
        if len(word) >= 4:
            for w in some:
                most = 1 + (len(w) >= 8)
                if len(w) >= 4 and len(set(w) - letters) <= most and osa(word, w, most) <= most:
                    return w
            for w in self.by_first.get(word[1], []):  # the first letter lost or swapped with the next
                if len(w) >= 6 and word[0] + word[2:] == w[1:] and word[1] == w[0]:
                    return w
            for w in self.share if len(word) >= 5 else ():
                if w[1:] == word and len(w) >= 6:
                    return w
        if 2 <= len(word) <= 9:
            for w in some:
                if abbreviates(word, w):
                    return w
        if 5 <= len(word) <= 9:  # an abbreviation with a letter too many
            for w in some:
                if len(letters - set(w)) <= 1 and any(abbreviates(word[:i] + word[i + 1 :], w) for i in range(1, len(word))):
                    return w
        return None

    def _glued(self, word: str) -> tuple[str, str, bool] | None:
        """(what stands before, common word, whether it is whole) if a common word, its beginning or a misspelling of it ends ``word``."""
        for k in range(len(word) - 4, 3, -1):
            if (w := self.endings.get(word[-k:])) is not None:
                return word[:-k], w, len(w) == k
        for i in range(4, len(word) - 4):
            for w in self.by_first.get(word[i], []):
                if len(w) >= 6 and abs(len(word) - i - len(w)) <= 1 and w not in PLACES and osa(word[i:], w, 1) == 1:
                    return word[:i], w, True
        return None

    def _alike(self, a: str, b: str) -> float:
        """0 to 1; a word that abbreviates the other counts almost as equal, two different common words not at all."""
        if a == b:
            return 1.0
        if a in self.share and b in self.share:
            return 0.0
        short, word = sorted((a, b), key=len)
        known = self.describing(word)
        if known and (abbreviates(short, word) or abbreviates(short, known)):
            return 0.95
        if len(short) >= 6 and word.startswith(short):
            return 0.9
        most = 2 if len(word) >= 9 else 1
        d = osa(short, word, most) if short[0] == word[0] else most + 1
        return 1 - d / len(word) if d <= most else 0.0

    def _readings(self, word: str) -> list[str]:
        """The common words that a word is or may abbreviate."""
        return [word] if word in self.share else [w for w in self.by_first.get(word[0], []) if abbreviates(word, w)]

    def _weight(self, word: str) -> float:
        """What a word tells: the square of its information; of an abbreviation with several readings the least."""
        share = max((self.share[w] for w in self._readings(word)), default=TELLS)
        return math.log(1 / min(share, 0.9)) ** 2

    def _may_tell(self, word: str) -> bool:
        """Whether a word, as one of its readings, tells enough to stand for an owner's trade."""
        readings = self._readings(word)
        return not readings or min(self.share[w] for w in readings) < TELLS

    def _parse(self, name: str) -> Name | None:
        """None if no core is left: such a name can't identify anyone."""
        core: list[str] = []
        described: list[str] = []
        given: list[str] = []
        is_org = False
        for w in words(name):
            if w in DROPPED:
                continue
            if w in GIVEN:
                given.append(GIVEN[w])
            elif len(w) == 1:
                given.append(w)
            elif (d := self.describing(w)) is not None:
                is_org |= d not in PLACES
                described.append(w if w not in self.share and d not in PLACES and abbreviates(w, d) else d)
            else:
                parts = self.glued(w)
                if parts and parts[2]:
                    is_org = True
                    core.append(parts[0])
                    described.append(parts[1])
                elif len(w) >= 3:
                    core.append(w)
        if not core:
            return None
        if not any(self.may_tell(w) for w in described if w not in PLACES):  # only then an ending like a word's beginning is one
            for n, w in enumerate(core):
                if parts := self.glued(w):
                    is_org = True
                    core[n] = parts[0]
                    described.append(parts[1])
        if is_org:
            longest = max(map(len, core))
            core = [w for w in core if 2 * len(w) > longest]  # short remnants are unread abbreviations
            return Name("org", tuple(sorted(set(core))), tuple(sorted(set(described))))
        return Name("person", tuple(sorted(set(core))), (), given[0] if given else "")

    def same_trade(self, a: tuple[str, ...], b: tuple[str, ...]) -> float:
        """Similarity of the common words. One of two lists may be cut short, so it is the better direction among those that start
        from a list that tells something; lists that tell nothing are the same unless both have what the other lacks."""
        where = [tuple(w for w in x if w in PLACES) for x in (a, b)]
        if all(where) and not set(where[0]) & set(where[1]):
            return 0.0  # north and south
        a, b = (tuple(w for w in x if w not in PLACES) for x in (a, b))
        told = [any(map(self.may_tell, x)) for x in (a, b)]
        if not any(told):
            return max(one_way(a, b, self.alike, self.weight), one_way(b, a, self.alike, self.weight)) if a and b else 1.0
        return max(one_way(x, y, self.alike, self.weight) for x, y, t in ((a, b, told[0]), (b, a, told[1])) if t)

    def same_owner(self, a: Name, b: Name, core: float = 0.78, trade: float = 0.75) -> bool:
        """Organisations: alike in core and common words. People: alike in surname, with given names that agree or abbreviate; of
        two without a given name both words of the name must be alike."""
        if a.kind != b.kind or not same_core(a.core, b.core, core):
            return False
        if a.kind == "org":
            return self.same_trade(a.descriptor, b.descriptor) >= trade
        x, y = sorted((a.given, b.given), key=len)
        return (y.startswith(x) if len(x) == 1 else x == y) if x else not y and min(len(a.core), len(b.core)) > 1


def word_counts(names: Iterable[str]) -> dict[str, int]:
    """Names that have a word, by word."""
    out: dict[str, int] = {}
    for name in names:
        for w in set(words(name)):
            out[w] = out.get(w, 0) + 1
    return out


PLAIN = Vocabulary()  # of the general words alone

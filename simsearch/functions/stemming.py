"""Snowball stemmers as Spark expressions.

The published algorithms work on the end of a word: find the longest suffix of
a list, look at what stands before it and at the region it lies in, and cut or
replace it. Here an array of words is carried through one ``transform`` per
step, each word with the few values the next step needs:

* ``w``  the word so far, ``word`` as it came in
* ``s``  the suffix the current step found, '' for none
* ``t``  the word without that suffix
* ``p1``, ``p2``, ``pv``  where the regions R1, R2 and RV start

A step sees its inputs by name and is worked out once, so the expression grows
with the number of steps only, and everything stays inside the JVM. A language
that is not handled raises; words never pass through silently.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F


class _Word:
    """One word inside a step; its values are read as attributes."""

    def __init__(self, row: Column):
        self._row = row

    def __getattr__(self, name: str) -> Column:
        return self._row[name]

    def inside(self, region: Column) -> Column:
        """Whether the suffix that was found lies in the region."""
        return F.length(self.t) >= region

    def before(self, region: Column, letters: int) -> Column:
        """Whether the last letters of what precedes the suffix lie in the region."""
        return F.length(self.t) - letters >= region


class _Words:
    """An array of words and the values each of them carries."""

    def __init__(self, words: Column):
        self.rows = F.transform(words, lambda w: F.struct(w.alias("word"), w.alias("w")))

    def let(self, **steps: Callable[[_Word], Column]) -> _Words:
        """Set values, all from those before this call."""

        def step(row: Column) -> Column:
            after = row
            for name, value in steps.items():
                after = after.withField(name, value(_Word(row)))
            return after

        self.rows = F.transform(self.rows, step)
        return self

    def find(self, suffixes: Iterable[str], region: str | None = None) -> _Words:
        """Set ``s`` and ``t``; with a region, only suffixes wholly inside it count."""
        pattern = "(?:" + "|".join(suffixes) + ")$"

        def suffix(q: _Word) -> Column:
            where = q.w if region is None else _tail(q.w, getattr(q, region))
            return F.regexp_extract(where, pattern, 0)

        self.let(s=suffix)
        return self.let(t=lambda q: _short(q.w, F.length(q.s)))

    def regions(self, vowels: str, exceptions: str = "") -> _Words:
        v, c = f"[{vowels}]", f"[^{vowels}]"
        first = f"(?:{exceptions}.*?{v}{c})"
        return self.let(
            p1=lambda q: _region(q.w, f"^{first}"),
            p2=lambda q: _region(q.w, f"^{first}.*?{v}{c}"),
        )


def _short(word: Column, by) -> Column:
    """The word without its last ``by`` characters."""
    return F.substring(word, F.lit(1), F.length(word) - by)


def _tail(word: Column, start: Column) -> Column:
    return F.substring(word, start + 1, F.length(word))


def _ends(word: Column, suffixes: str) -> Column:
    return word.rlike("(?:" + suffixes + ")$")


def _region(word: Column, prefix: str) -> Column:
    """Start of the region after ``prefix``; the word's end if it has none."""
    found = F.length(F.regexp_extract(word, prefix, 0))
    return F.when(found == 0, F.length(word)).otherwise(found)


def _drop(word: Column, suffixes: str, region: Column, otherwise=None) -> Column:
    """Cut one of equally meant suffixes if it lies in the region."""
    found = F.length(F.regexp_extract(word, "(?:" + suffixes + ")$", 0))
    kept = word if otherwise is None else F.concat(_short(word, found), otherwise)
    return (
        F.when(found == 0, word)
        .when(F.length(word) - found >= region, _short(word, found))
        .otherwise(kept)
    )


def _mapped(key: Column, table: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(v) for kv in table.items() for v in kv]), key)


def _romance_rv(vowels: str) -> Callable[[_Word], Column]:
    v, c = f"[{vowels}]", f"[^{vowels}]"
    return lambda q: _region(q.w, f"^(?:.{c}.*?{v}|{v}{v}.*?{c}|{c}{v}.)")


# --- English -----------------------------------------------------------------

# Fixed values of the published algorithm.
_EN_VOWELS = "aeiouy"
_EN_SPECIAL = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
_EN_FINISHED = "inning outing canning herring earring proceed exceed succeed".split()
_EN_STEP2 = {
    "ization": "ize", "ational": "ate", "ousness": "ous", "iveness": "ive", "fulness": "ful",
    "tional": "tion", "lessli": "less", "biliti": "ble", "entli": "ent", "ation": "ate",
    "alism": "al", "aliti": "al", "fulli": "ful", "ousli": "ous", "iviti": "ive",
    "enci": "ence", "anci": "ance", "abli": "able", "izer": "ize", "ator": "ate",
    "alli": "al", "bli": "ble", "ogi": "og", "li": "",
}
_EN_STEP3 = {
    "ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic",
    "ative": "", "ical": "ic", "ness": "", "ful": "",
}
_EN_STEP4 = """
    ement ance ence able ible ment ant ent ism ate iti ous ive ize ion al er ic
""".split()
_EN_SHORT = "(?:[^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$"


def _english(ws: _Words) -> _Words:
    ws.let(w=lambda q: F.regexp_replace(F.regexp_replace(q.w, "^'", ""), "^y", "Y"))
    ws.let(w=lambda q: F.regexp_replace(q.w, "([aeiouy])y", "$1Y"))
    ws.regions(_EN_VOWELS, "gener|commun|arsen|")
    ws.let(w=lambda q: F.regexp_replace(q.w, "(?:'s'|'s|')$", ""))
    ws.let(
        w=lambda q: F.when(q.w.endswith("sses") | q.w.rlike("..(?:ied|ies)$"), _short(q.w, 2))
        .when(_ends(q.w, "ied|ies"), _short(q.w, 1))
        .when(_ends(q.w, "us|ss"), q.w)
        .when(q.w.rlike("[aeiouy].+s$"), _short(q.w, 1))
        .otherwise(q.w)
    )
    ws.let(plain=lambda q: q.w)

    def verb_ending(q: _Word) -> Column:
        cut = (
            F.when(_ends(q.t, "at|bl|iz"), F.concat(q.t, F.lit("e")))
            .when(_ends(q.t, "bb|dd|ff|gg|mm|nn|pp|rr|tt"), _short(q.t, 1))
            .when((F.length(q.t) <= q.p1) & q.t.rlike(_EN_SHORT), F.concat(q.t, F.lit("e")))
            .otherwise(q.t)
        )
        return (
            F.when(q.s == "", q.w)
            .when(
                q.s.isin("eed", "eedly"),
                F.when(q.inside(q.p1), F.concat(q.t, F.lit("ee"))).otherwise(q.w),
            )
            .when(q.t.rlike("[aeiouy]"), cut)
            .otherwise(q.w)
        )

    ws.find(["eedly", "ingly", "edly", "eed", "ing", "ed"]).let(w=verb_ending)
    ws.let(w=lambda q: F.regexp_replace(q.w, "(?<=.[^aeiouy])[yY]$", "i"))
    ws.find(_EN_STEP2).let(
        w=lambda q: F.when((q.s == "") | ~q.inside(q.p1), q.w)
        .when((q.s == "ogi") & ~q.t.endswith("l"), q.w)
        .when((q.s == "li") & ~_ends(q.t, "[cdeghkmnrt]"), q.w)
        .otherwise(F.concat(q.t, _mapped(q.s, _EN_STEP2)))
    )
    ws.find(_EN_STEP3).let(
        w=lambda q: F.when((q.s == "") | ~q.inside(q.p1), q.w)
        .when((q.s == "ative") & ~q.inside(q.p2), q.w)
        .otherwise(F.concat(q.t, _mapped(q.s, _EN_STEP3)))
    )
    ws.find(_EN_STEP4).let(
        w=lambda q: F.when((q.s == "") | ~q.inside(q.p2), q.w)
        .when((q.s == "ion") & ~_ends(q.t, "[st]"), q.w)
        .otherwise(q.t)
    )
    ws.find(["e", "l"]).let(
        w=lambda q: F.when((q.s == "") | ~q.inside(q.p1), q.w)
        .when((q.s == "e") & (q.inside(q.p2) | ~q.t.rlike(_EN_SHORT)), q.t)
        .when((q.s == "l") & q.inside(q.p2) & q.t.endswith("l"), q.t)
        .otherwise(q.w)
    )
    return ws.let(
        w=lambda q: F.coalesce(
            F.when(F.length(q.word) < 3, q.word),
            _mapped(q.word, _EN_SPECIAL),
            F.when(q.plain.isin(_EN_FINISHED), q.plain),
            F.regexp_replace(q.w, "Y", "y"),
        )
    )


# --- Spanish -----------------------------------------------------------------

# Fixed values of the published algorithm.
_ES_VOWELS = "aeiouáéíóúü"
_ES_PRONOUN = "selas selos sela selo las les los nos me se la le lo".split()
_ES_DELETE = """
    anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos
    osas amiento amientos imiento imientos
""".split()
_ES_IC = """
    adora ador ación adoras adores aciones ante antes ancia ancias
""".split()
_ES_SWAP = {
    "logía": "log", "logías": "log", "ución": "u", "uciones": "u", "encia": "ente",
    "encias": "ente",
}
_ES_IDAD = ["idad", "idades"]
_ES_IVA = ["iva", "ivo", "ivas", "ivos"]
_ES_Y = "ya ye yan yen yeron yendo yo yó yas yes yais yamos".split()
_ES_EN = ["en", "es", "éis", "emos"]
_ES_VERB = """
    arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás
    eríais ería eréis eríamos eremos erá eré irían irías irán irás iríais iría iréis iríamos
    iremos irá iré aba ada ida ía ara iera ad ed id ase iese aste iste an aban ían aran ieran
    asen iesen aron ieron ado ido ando iendo ió ar er ir as abas adas idas ías aras ieras ases
    ieses ís áis abais íais arais ierais aseis ieseis asteis isteis ados idos amos ábamos
    íamos imos áramos iéramos iésemos ásemos
""".split()


def _spanish(ws: _Words) -> _Words:
    ws.regions(_ES_VOWELS).let(pv=_romance_rv(_ES_VOWELS))
    ws.find(_ES_PRONOUN).let(
        verb=lambda q: F.regexp_extract(
            q.t, "(?:iéndo|ándo|ár|ér|ír|ando|iendo|ar|er|ir|(?<=u)yendo)$", 0
        )
    )
    ws.let(
        w=lambda q: F.when(
            (q.s != "") & (q.verb != "") & q.before(q.pv, F.length(q.verb)),
            F.concat(_short(q.t, F.length(q.verb)), F.translate(q.verb, "áéí", "aei")),
        ).otherwise(q.w)
    )

    def standard(q: _Word) -> Column:
        amente = F.when(
            q.t.endswith("iv"),
            F.when(q.before(q.p2, 2), _drop(_short(q.t, 2), "at", q.p2)).otherwise(q.t),
        ).otherwise(_drop(q.t, "os|ic|ad", q.p2))
        return (
            F.when(q.s == "amente", F.when(q.inside(q.p1), amente))
            .when((q.s == "") | ~q.inside(q.p2), F.lit(None).cast("string"))
            .when(q.s.isin(_ES_DELETE), q.t)
            .when(q.s.isin(_ES_IC), _drop(q.t, "ic", q.p2))
            .when(q.s == "mente", _drop(q.t, "ante|able|ible", q.p2))
            .when(q.s.isin(_ES_IDAD), _drop(q.t, "abil|ic|iv", q.p2))
            .when(q.s.isin(_ES_IVA), _drop(q.t, "at", q.p2))
            .otherwise(F.concat(q.t, _mapped(q.s, _ES_SWAP)))
        )

    ws.find(
        [*_ES_DELETE, *_ES_IC, *_ES_SWAP, *_ES_IDAD, *_ES_IVA, "amente", "mente"]
    ).let(cut=standard)
    ws.let(w=lambda q: F.coalesce(q.cut, q.w), done=lambda q: q.cut.isNotNull())
    ws.find(_ES_Y, "pv").let(y=lambda q: ~q.done & (q.s != "") & q.t.endswith("u"))
    ws.let(w=lambda q: F.when(q.y, q.t).otherwise(q.w), done=lambda q: q.done | q.y)
    ws.find([*_ES_EN, *_ES_VERB], "pv").let(
        w=lambda q: F.when(q.done | (q.s == ""), q.w)
        .when(q.s.isin(_ES_EN) & q.t.endswith("gu"), _short(q.t, 1))
        .otherwise(q.t)
    )
    ws.find(["os", "a", "o", "á", "í", "ó", "e", "é"], "pv").let(
        w=lambda q: F.when(q.s == "", q.w)
        .when(q.s.isin("e", "é") & q.t.endswith("gu") & q.before(q.pv, 1), _short(q.t, 1))
        .otherwise(q.t)
    )
    return ws.let(w=lambda q: F.translate(q.w, "áéíóú", "aeiou"))


# --- French ------------------------------------------------------------------

# Fixed values of the published algorithm.
_FR_VOWELS = "aeiouyâàëéêèïîôûù"
_FR_DELETE = """
    ance iqUe isme able iste eux ances iqUes ismes ables istes
""".split()
_FR_IC = "atrice ateur ation atrices ateurs ations".split()
_FR_SWAP = {
    "logie": "log", "logies": "log", "usion": "u", "ution": "u", "usions": "u",
    "utions": "u", "ence": "ent", "ences": "ent",
}
_FR_EMENT = ["ement", "ements"]
_FR_ITE = ["ité", "ités"]
_FR_IF = ["if", "ive", "ifs", "ives"]
_FR_EUSE = ["euse", "euses"]
_FR_ISSEMENT = ["issement", "issements"]
_FR_MENT = ["ment", "ments"]
_FR_I = """
    îmes ît îtes i ie ies ir ira irai iraIent irais irait iras irent irez iriez irions irons
    iront is issaIent issais issait issant issante issantes issants isse issent isses issez
    issiez issions issons it
""".split()
_FR_E = """
    é ée ées és èrent er era erai eraIent erais erait eras erez eriez erions erons eront ez
    iez
""".split()
_FR_A = """
    âmes ât âtes a ai aIent ais ait ant ante antes ants as asse assent asses assiez assions
""".split()


def _french(ws: _Words) -> _Words:
    v, c = f"[{_FR_VOWELS}]", f"[^{_FR_VOWELS}]"

    def mark(q: _Word) -> Column:
        # u and i between vowels, y next to a vowel and u after q act as consonants.
        word = F.regexp_replace(q.w, "qu", "qU")
        word = F.regexp_replace(word, f"(?<={v})u(?={v})", "U")
        word = F.regexp_replace(word, f"(?<={v})i(?={v})", "I")
        return F.regexp_replace(word, f"(?<={v})y|y(?={v})", "Y")

    ws.let(w=mark).regions(_FR_VOWELS)
    ws.let(pv=lambda q: _region(q.w, f"^(?:par|col|tap|{v}{v}.|.{c}*?{v})"))

    def standard(q: _Word) -> Column:
        ement = (
            F.when(q.t.endswith("iv") & q.before(q.p2, 2), _drop(_short(q.t, 2), "at", q.p2))
            .when(
                q.t.endswith("eus"),
                F.when(q.before(q.p2, 3), _short(q.t, 3))
                .when(q.before(q.p1, 3), F.concat(_short(q.t, 1), F.lit("x")))
                .otherwise(q.t),
            )
            .when(_ends(q.t, "abl|iqU"), _drop(q.t, "abl|iqU", q.p2))
            .when(
                _ends(q.t, "[iI]èr") & q.before(q.pv, 3), F.concat(_short(q.t, 3), F.lit("i"))
            )
            .otherwise(q.t)
        )
        ite = (
            F.when(q.t.endswith("abil"), _drop(q.t, "abil", q.p2, F.lit("abl")))
            .when(q.t.endswith("ic"), _drop(q.t, "ic", q.p2, F.lit("iqU")))
            .otherwise(_drop(q.t, "iv", q.p2))
        )
        iv = F.when(
            q.t.endswith("at") & q.before(q.p2, 2),
            _drop(_short(q.t, 2), "ic", q.p2, F.lit("iqU")),
        ).otherwise(q.t)
        return (
            F.when(q.s == "", F.lit(None).cast("string"))
            .when(q.s == "eaux", F.concat(q.t, F.lit("eau")))
            .when(q.s == "aux", F.when(q.inside(q.p1), F.concat(q.t, F.lit("al"))))
            .when(q.s.isin(_FR_EMENT), F.when(q.inside(q.pv), ement))
            .when(
                q.s.isin(_FR_EUSE),
                F.when(q.inside(q.p2), q.t)
                .when(q.inside(q.p1), F.concat(q.t, F.lit("eux"))),
            )
            .when(q.s.isin(_FR_ISSEMENT), F.when(q.inside(q.p1) & _ends(q.t, c), q.t))
            .when(q.s == "amment", F.when(q.inside(q.pv), F.concat(q.t, F.lit("ant"))))
            .when(q.s == "emment", F.when(q.inside(q.pv), F.concat(q.t, F.lit("ent"))))
            .when(q.s.isin(_FR_MENT), F.when(_ends(q.t, v) & q.before(q.pv, 1), q.t))
            .when(~q.inside(q.p2), F.lit(None).cast("string"))
            .when(q.s.isin(_FR_DELETE), q.t)
            .when(q.s.isin(_FR_IC), _drop(q.t, "ic", q.p2, F.lit("iqU")))
            .when(q.s.isin(_FR_ITE), ite)
            .when(q.s.isin(_FR_IF), iv)
            .otherwise(F.concat(q.t, _mapped(q.s, _FR_SWAP)))
        )

    ws.find(
        [*_FR_DELETE, *_FR_IC, *_FR_SWAP, *_FR_EMENT, *_FR_ITE, *_FR_IF, *_FR_EUSE,
         *_FR_ISSEMENT, *_FR_MENT, "eaux", "aux", "amment", "emment"]
    ).let(cut=standard)
    # Endings in -ment leave a verb behind, so the verb steps still follow them.
    ws.let(
        w=lambda q: F.coalesce(q.cut, q.w),
        changed=lambda q: q.cut.isNotNull(),
        done=lambda q: q.cut.isNotNull() & ~q.s.isin(*_FR_MENT, "amment", "emment"),
    )
    ws.find(_FR_I, "pv").let(
        i=lambda q: ~q.done & (q.s != "") & _ends(q.t, c) & q.before(q.pv, 1)
    )
    ws.let(
        w=lambda q: F.when(q.i, q.t).otherwise(q.w),
        changed=lambda q: q.changed | q.i,
        done=lambda q: q.done | q.i,
    )
    ws.find(["ions", *_FR_E, *_FR_A], "pv").let(
        e=lambda q: ~q.done & (q.s != "") & ((q.s != "ions") | q.inside(q.p2))
    )
    ws.let(
        w=lambda q: F.when(~q.e, q.w)
        .when(q.s.isin(_FR_A) & q.t.endswith("e") & q.before(q.pv, 1), _short(q.t, 1))
        .otherwise(q.t),
        changed=lambda q: q.changed | q.e,
    )
    ws.let(
        w=lambda q: F.when(
            q.changed, F.regexp_replace(F.regexp_replace(q.w, "Y$", "i"), "ç$", "c")
        ).otherwise(F.regexp_replace(q.w, "(?<=[^aiouès])s$", ""))
    )
    ws.find(["ion", "ier", "ière", "Ier", "Ière", "e", "ë"], "pv").let(
        w=lambda q: F.when(q.changed | (q.s == ""), q.w)
        .when(
            q.s == "ion",
            F.when(q.inside(q.p2) & _ends(q.t, "[st]") & q.before(q.pv, 1), q.t).otherwise(q.w),
        )
        .when(q.s == "e", q.t)
        .when(q.s == "ë", F.when(q.t.endswith("gu"), q.t).otherwise(q.w))
        .otherwise(F.concat(q.t, F.lit("i")))
    )
    ws.let(
        w=lambda q: F.when(_ends(q.w, "enn|onn|ett|ell|eill"), _short(q.w, 1)).otherwise(q.w)
    )
    ws.let(w=lambda q: F.regexp_replace(q.w, f"[éè](?={c}+$)", "e"))
    return ws.let(w=lambda q: F.translate(q.w, "IUY", "iuy"))


# --- German ------------------------------------------------------------------

# Fixed value of the published algorithm.
_DE_VOWELS = "aeiouyäöü"


def _german(ws: _Words) -> _Words:
    v = f"[{_DE_VOWELS}]"

    def mark(q: _Word) -> Column:
        word = F.regexp_replace(q.w, "ß", "ss")
        word = F.regexp_replace(word, f"(?<={v})u(?={v})", "U")
        return F.regexp_replace(word, f"(?<={v})y(?={v})", "Y")

    ws.let(w=mark).regions(_DE_VOWELS).let(p1=lambda q: F.greatest(q.p1, F.lit(3)))
    ws.find(["em", "ern", "er", "e", "en", "es", "s"]).let(
        w=lambda q: F.when((q.s == "") | ~q.inside(q.p1), q.w)
        .when((q.s == "s") & ~_ends(q.t, "[bdfghklmnrt]"), q.w)
        .when(q.s.isin("e", "en", "es") & q.t.endswith("niss"), _short(q.t, 1))
        .otherwise(q.t)
    )
    ws.find(["en", "er", "est", "st"]).let(
        w=lambda q: F.when((q.s == "") | ~q.inside(q.p1), q.w)
        .when((q.s == "st") & ~q.t.rlike("...[bdfghklmnt]$"), q.w)
        .otherwise(q.t)
    )
    ws.find(["end", "ung", "ig", "ik", "isch", "lich", "heit", "keit"]).let(
        w=lambda q: F.when((q.s == "") | ~q.inside(q.p2), q.w)
        .when(
            q.s.isin("end", "ung"),
            F.when(q.t.endswith("eig"), q.t).otherwise(_drop(q.t, "ig", q.p2)),
        )
        .when(q.s.isin("ig", "ik", "isch"), F.when(q.t.endswith("e"), q.w).otherwise(q.t))
        .when(q.s.isin("lich", "heit"), _drop(q.t, "er|en", q.p1))
        .otherwise(_drop(q.t, "lich|ig", q.p2))
    )
    return ws.let(w=lambda q: F.translate(q.w, "UYäöü", "uyaou"))


# --- Italian -----------------------------------------------------------------

# Fixed values of the published algorithm.
_IT_VOWELS = "aeiouàèìòù"
_IT_PRONOUN = """
    gliela gliele glieli glielo gliene sene mela mele meli melo mene tela tele teli telo tene
    cela cele celi celo cene vela vele veli velo vene gli ci la le li lo mi ne si ti vi
""".split()
_IT_DELETE = """
    anza anze ico ici ica ice iche ichi ismo ismi abile abili ibile ibili ista iste isti istà
    istè istì oso osi osa ose mente atrice atrici ante anti
""".split()
_IT_IC = ["azione", "azioni", "atore", "atori"]
_IT_SWAP = {
    "logia": "log", "logie": "log", "uzione": "u", "uzioni": "u", "usione": "u",
    "usioni": "u", "enza": "ente", "enze": "ente",
}
_IT_MENTO = ["amento", "amenti", "imento", "imenti"]
_IT_IVO = ["ivo", "ivi", "iva", "ive"]
_IT_VERB = """
    ammo ando ano are arono asse assero assi assimo ata ate ati ato ava avamo avano avate avi
    avo emmo enda ende endi endo erà erai eranno ere erebbe erebbero erei eremmo eremo ereste
    eresti erete erò erono essero ete eva evamo evano evate evi evo Yamo iamo immo irà irai
    iranno ire irebbe irebbero irei iremmo iremo ireste iresti irete irò irono isca iscano
    isce isci isco iscono issero ita ite iti ito iva ivamo ivano ivate ivi ivo ono uta ute uti
    uto ar ir
""".split()


def _italian(ws: _Words) -> _Words:
    v = f"[{_IT_VOWELS}]"

    def mark(q: _Word) -> Column:
        word = F.regexp_replace(F.translate(q.w, "áéíóú", "àèìòù"), "qu", "qU")
        word = F.regexp_replace(word, f"(?<={v})u(?={v})", "U")
        return F.regexp_replace(word, f"(?<={v})i(?={v})", "I")

    ws.let(w=mark).regions(_IT_VOWELS).let(pv=_romance_rv(_IT_VOWELS))
    ws.find(_IT_PRONOUN).let(
        w=lambda q: F.when(q.s == "", q.w)
        .when(_ends(q.t, "ando|endo") & q.before(q.pv, 4), q.t)
        .when(_ends(q.t, "ar|er|ir") & q.before(q.pv, 2), F.concat(q.t, F.lit("e")))
        .otherwise(q.w)
    )

    def standard(q: _Word) -> Column:
        amente = F.when(
            q.t.endswith("iv"),
            F.when(q.before(q.p2, 2), _drop(_short(q.t, 2), "at", q.p2)).otherwise(q.t),
        ).otherwise(_drop(q.t, "os|ic|abil", q.p2))
        ivo = F.when(
            q.t.endswith("at") & q.before(q.p2, 2), _drop(_short(q.t, 2), "ic", q.p2)
        ).otherwise(q.t)
        return (
            F.when(q.s == "amente", F.when(q.inside(q.p1), amente))
            .when(q.s.isin(_IT_MENTO), F.when(q.inside(q.pv), q.t))
            .when((q.s == "") | ~q.inside(q.p2), F.lit(None).cast("string"))
            .when(q.s.isin(_IT_DELETE), q.t)
            .when(q.s.isin(_IT_IC), _drop(q.t, "ic", q.p2))
            .when(q.s == "ità", _drop(q.t, "abil|ic|iv", q.p2))
            .when(q.s.isin(_IT_IVO), ivo)
            .otherwise(F.concat(q.t, _mapped(q.s, _IT_SWAP)))
        )

    ws.find(
        [*_IT_DELETE, *_IT_IC, *_IT_SWAP, *_IT_MENTO, *_IT_IVO, "amente", "ità"]
    ).let(cut=standard)
    ws.let(w=lambda q: F.coalesce(q.cut, q.w), done=lambda q: q.cut.isNotNull())
    ws.find(_IT_VERB, "pv").let(
        w=lambda q: F.when(q.done | (q.s == ""), q.w).otherwise(q.t)
    )
    ws.find(["a", "e", "i", "o", "à", "è", "ì", "ò"], "pv").let(
        w=lambda q: F.when(q.s == "", q.w)
        .when(q.t.endswith("i") & q.before(q.pv, 1), _short(q.t, 1))
        .otherwise(q.t)
    )
    ws.let(
        w=lambda q: F.when(
            _ends(q.w, "ch|gh") & (F.length(q.w) - 2 >= q.pv), _short(q.w, 1)
        ).otherwise(q.w)
    )
    return ws.let(w=lambda q: F.translate(q.w, "IU", "iu"))


_STEMMERS: dict[str, Callable[[_Words], _Words]] = {
    "english": _english,
    "spanish": _spanish,
    "french": _french,
    "german": _german,
    "italian": _italian,
}


# Unresolved expressions by language; making one takes about a second. Those of an
# application that has ended are of no use and are dropped.
_EXPRESSIONS: dict[tuple[str, str, str], Column] = {}


def _expression(token: str, language: str) -> Column:
    application = SparkContext.getOrCreate().applicationId
    key = (application, token, language)
    if key not in _EXPRESSIONS:
        for old in [k for k in _EXPRESSIONS if k[0] != application]:
            del _EXPRESSIONS[old]
        words = _STEMMERS[language](_Words(F.array(F.col(token))))
        _EXPRESSIONS[key] = words.rows[0]["w"]
    return _EXPRESSIONS[key]


def stem(token: str, language: str, languages: Iterable[str] | None = None) -> Column:
    """Stem of the column ``token`` in the language named by the column ``language``.

    ``languages`` narrows the expression to languages known to occur; a token in
    any other language is an error when it is met.
    """
    chosen = list(_STEMMERS) if languages is None else list(languages)
    unknown = [name for name in chosen if name not in _STEMMERS]
    if unknown:
        raise ValueError(f"no stemmer for language: {unknown}")
    result = F.when(F.col(token).isNull(), F.lit(None).cast("string"))
    for name in chosen:
        result = result.when(F.col(language) == name, _expression(token, name))
    failed = F.concat(
        F.lit("no stemmer for language: "), F.coalesce(F.col(language), F.lit("null"))
    )
    return result.otherwise(F.raise_error(failed).cast("string"))

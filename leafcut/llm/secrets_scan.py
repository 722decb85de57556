"""Secret scans: fixed patterns, and zstandard novelty primed with code and identifier dictionaries.

The base finds assignments to sensitive names, access keys and hexadecimal keys. The method looks at every other long
string with a letter whose own name (name=value), line or line before speaks of something sensitive, and at the bodies
under PEM headers: how many bytes does it add to the compressed context, when the compressor already knows common code and
identifiers? One that hardly compresses is reported as `novel`. Strings of 16 characters or more count; of digits alone, none.
Of a web address, and of a string that is for the most part words and numbers between `/`, `-`, `_`, `.`, `+` and `~`, only the pieces
between these signs count, so a key that is made of short words is not found.

Defined results: a null text is empty and has no spans; spans are code points, end exclusive; base spans stay as they are,
and a novel span overlaps none of them; every row of documents gives a row, repeated ones too; long texts are scanned whole;
other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed patterns of the base, with the group that is measured and its least length.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)
KINDS = (*(x[0] for x in BASE), "novel")
_LONG_HEX = re.compile(r"[0-9a-f]{32,}")
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: A candidate's own name, its line or the line before must name one of these, lines within CONTEXT characters at the end.
SENSITIVE = re.compile(r"password|passwd|passphrase|secret|token|api.?key|private.?key|access.?key|credential|bearer|authorization|signature|client.?id|session.?id|connection.?string", re.I | re.A)
_HINTS = ("pass", "secret", "token", "key", "credential", "bearer", "authoriz", "signature", "client", "session", "connection")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.~-]{16,}")
#: Parts of a candidate: names before `=`, and the value with its padding.
_PART = re.compile(r"[^=]+(?:=+$)?")
#: Pieces of an address or identifier, and what is plain in one: a number, or letters of one case with a capital at most in front.
_PIECE = re.compile(r"[A-Za-z0-9]+=*")
_PLAIN = re.compile(r"[0-9]+|[A-Z]?[a-z]+|[A-Z]+")
_UNSAYABLE = re.compile(r"[^aeiouy0-9]{5}|\A[^aeiouy0-9]{4,}\Z", re.I)
#: The longest plain piece, and the share of plain pieces from which only the others are measured.
PLAIN_LENGTH, PLAIN_SHARE = 14, 0.6
#: A PEM header, and its body: up to the next dashes, or without any the lines that look like one.
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]+)-----")
_PEM_LINES = re.compile(r"(?:[ \t]*(?:[A-Za-z0-9+/=]*|[A-Za-z0-9-]+:[^\n]*)[ \t\r]*(?:\n|\Z))*")
CONTEXT, LINE_BYTES = 60, 400
#: Marginal bytes per character from which a string counts as incompressible: random base64 costs about 0.75, hexadecimal 0.5, prose and identifiers less.
NOVELTY, NOVELTY_HEX = 0.62, 0.45
#: Put before the context of a string without digits, so that letters cost what they cost in prose however short the context.
_PROSE = """The committee met on Tuesday to discuss how the rules of the company should be changed, because many people had asked for it. Die Versammlung begann am Abend, und niemand
wusste, warum sich die Entscheidung so lange verschoben hatte. Nous avons marché le long de la rivière pendant que les autres préparaient le repas. Los vecinos esperaban desde hacía tiempo una respuesta."""
#: Words that code and configuration are made of; the dictionary holds each alone and joined with its neighbours, as identifiers are.
_WORDS = """access account action active address admin alpha api app apple application array attribute authorization auth base bearer begin bool build button cache callback
certificate channel character class client code color column command comment common component config configuration connect connection const container content context
control cookie copy count create credential current custom data database date default define delete description destination develop device dictionary directory disable
document domain download driver element email enable encoding endpoint engine entry environment error event example exception execute export extension external false field
file filter final find first float font format frame from function gateway generate global graph group handler hash header height hidden host http https identifier image
import include index info init input insert install instance integer interface internal item javascript json key label language last layout length level library line link
list listener load local location lock logger login main manager map master match maximum member memory message method metadata minimum mode model module monitor mount name
namespace network next node none normal notification null number object offset operation option order origin output package page panel parameter parent parse password path
pattern payload permission platform plugin point policy port position prefix previous print private process production profile program project property protocol provider
proxy public publish python query queue random range raw read record reference refresh region register release remote remove render replace report repository request require
reset resource response result return role root route router rule runtime sample schema scope script search second secret section select self sender sequence serial server
service session setting shared signature simple single size socket source stack standard start state static status step storage store stream string struct style subject
submit suffix support switch symbol system table target task template test text thread time timeout timestamp title token tool total trace transaction transfer transform
true type undefined unique update upload url user username utility valid validate value variable vector version view virtual visible void warning web width window word worker
workspace write""".split()


def _dictionary() -> zstandard.ZstdCompressionDict:
    w = _WORDS
    text = "\n".join(f"{a}_{b} {a}{b.title()} {a}-{b} {a}.{b} {a.upper()}_{b.upper()}" for a, b in zip(w, w[1:] + w[:1], strict=True))
    return zstandard.ZstdCompressionDict((text + '\npassword = "token": "secret=api_key=https://www.example.com/index.html?id=0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ').encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class Scanner:
    def __init__(self):
        p = zstandard.ZstdCompressionParameters.from_level(12, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.zstd = zstandard.ZstdCompressor(dict_data=_dictionary(), compression_params=p)

    def base(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end), by start and kind."""
        out, low = [], text.lower()
        if any(x in low for x in _NAMES):
            out += [(m.start(), 0, m.end()) for m in BASE[0][1].finditer(text) if len(m[2]) >= BASE[0][3]]
        if "AKIA" in text:
            out += [(m.start(), 1, m.end()) for m in BASE[1][1].finditer(text) if len(m[0]) >= BASE[1][3]]
        # A run of 32 or more starts where the maximal run starts, so this finds what the base pattern finds and keeps.
        out += [(m.start(), 2, m.end()) for m in _LONG_HEX.finditer(text)]
        return sorted(out)

    def novelty(self, context: str, candidate: str) -> float:
        """Bytes that the candidate adds to its compressed context, per character."""
        before = context.encode("utf-8", "surrogatepass")
        return (len(self.zstd.compress(before + candidate.encode())) - len(self.zstd.compress(before))) / len(candidate)

    def novel(self, text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        low = text.lower()
        if not any(x in low for x in _HINTS):
            return []
        out, bodies = [], self.bodies(text)
        for m in CANDIDATE.finditer(text):
            before, address = None, m[0].startswith("www.") or m[0].startswith("//") and text.endswith(":", 0, m.start())
            for start, s in (x for part in self.parts(m) for x in self.pieces(*part, address)):
                if not re.search("[A-Za-z]", s) or any(a < start + len(s) and start < b for a, _, b in taken):
                    continue
                if not any(a <= start < b for a, b in bodies) and not SENSITIVE.search(text[m.start() : start]):
                    before = self.lines(text, m.start()) if before is None else before
                    if not SENSITIVE.search(before):
                        continue
                wide = text[max(0, start - LINE_BYTES) : start] + " " + text[start + len(s) : start + len(s) + LINE_BYTES // 2]
                if not re.search("[0-9]", s):
                    wide = _PROSE + wide
                if self.novelty(wide, s) >= (NOVELTY_HEX if re.fullmatch("[0-9a-fA-F-]+", s) else NOVELTY):
                    out.append((start, 3, start + len(s)))
        return out

    @staticmethod
    def parts(m: re.Match) -> list[tuple[int, str]]:
        """Starts and contents of what is measured in a candidate: names and value apart, or the whole if neither is long enough."""
        trim = lambda at, x: (at + len(x) - len(x.lstrip(".=~-_/")), x.strip(".=~-_/") if not x.endswith("=") else x.lstrip(".=~-_/"))
        long = [(at, x) for at, x in (trim(m.start() + p.start(), p[0]) for p in _PART.finditer(m[0])) if len(x) >= 16]
        return long or [(at, x) for at, x in (trim(m.start(), m[0]),) if len(x) >= 16]

    @staticmethod
    def pieces(start: int, s: str, address: bool) -> list[tuple[int, str]]:
        """The whole, or for an address or a string of plain pieces, those of its pieces that are long enough."""
        found = list(_PIECE.finditer(s))
        if not address:
            plain = sum(len(p[0]) for p in found if len(p[0]) <= PLAIN_LENGTH and _PLAIN.fullmatch(p[0]) and not _UNSAYABLE.search(p[0]))
            if len(found) < 2 or plain < PLAIN_SHARE * sum(len(p[0]) for p in found):
                return [(start, s)]
        return [(start + p.start(), p[0]) for p in found if len(p[0]) >= 16]

    @staticmethod
    def lines(text: str, start: int) -> str:
        """The ends, of CONTEXT characters, of the line up to start and of the last line before it that is not blank, as far as LINE_BYTES characters show them."""
        least = max(0, start - LINE_BYTES)
        head = text.rfind("\n", least, start) + 1
        if not head:
            return text[max(least, start - CONTEXT) : start]
        stop, least = head, max(0, head - LINE_BYTES)
        while stop > least and text[stop - 1].isspace():
            stop -= 1
        last = text[max(text.rfind("\n", least, stop) + 1, stop - CONTEXT, 0) : stop]
        return last + "\n" + text[max(head, start - CONTEXT) : start]

    @staticmethod
    def bodies(text: str) -> list[tuple[int, int]]:
        """Where the bodies of sensitive PEM blocks are."""
        out = []
        for m in _PEM.finditer(text) if "-----BEGIN " in text else ():
            if SENSITIVE.search(m[1]):
                end = text.find("-----END", m.end())
                other = text.find("-----BEGIN", m.end())
                closed = end >= 0 and not m.end() <= other < end
                out.append((m.end(), end if closed else m.end() + len(_PEM_LINES.match(text, m.end())[0])))
        return out

    def scan(self, text: str | None) -> tuple:
        text = text or ""
        base = self.base(text)
        every = sorted(base + self.novel(text, base))
        say = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
        return *(sum(k == i for _, k, _ in base) for i in range(3)), hashlib.sha256(say(base).encode()).hexdigest(), say(every)


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_novel for each document."""

    def run(batches):
        scanner = Scanner()
        for b in batches:
            got = [scanner.scan(x.as_py()) for x in b.column(1)]
            cols = list(zip(*got, strict=True)) if got else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            novel = pa.array([s.count("novel:") for s in cols[4]], pa.int64())
            yield pa.record_batch([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True)), novel], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long")

"""Secret scans that link the parts of one credential: identifier, secret and endpoint.

Strong findings are reported by themselves. Weak ones (a user name, a bare random string, a host)
are reported only if a part that completes them lies near by in the same document.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from autostrata.llm.common import whole
from autostrata.staging import materialize

# Code points within which two parts belong together, from start to start.
SCOPE = 400

# The base patterns, in the order of their names in a listing.
BASE_KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

# Weak parts: the role each would play in a credential.
_WEAK = (
    ("user", "identifier", re.compile(
        r"""(?:user(?:_?name)?|login|client_?id|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@+-]{3,})""",
        re.ASCII | re.IGNORECASE)),
    ("email", "identifier", re.compile(
        r"(?<![A-Za-z0-9._+-])[A-Za-z0-9._+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")),
    ("random", "secret", re.compile(
        r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/=_-]*[0-9])(?=[a-z0-9+/=_-]*[A-Z])[A-Za-z0-9+/=_-]{20,}")),
    ("url", "endpoint", re.compile(r"[a-z][a-z0-9+]{1,15}://[^\s\"'<>]{3,}")),
    ("host", "endpoint", re.compile(
        r"""(?:host(?:name)?|server|endpoint|bucket|region)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.:-]{3,})""",
        re.ASCII | re.IGNORECASE)),
)
_ROLE_OF_BASE = {"assign": "secret", "access": "identifier", "hex": "secret"}
# Letters of which a text must have one before its pattern is tried at all.
_NEEDS = {"user": ":=", "email": "@", "random": "0123456789", "url": ":", "host": ":="}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base findings: kind, start, end in code points, by start and then by kind as listed."""
    found = []
    if "=" in text or ":" in text:
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        found += [
            ("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20
        ]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], BASE_KINDS.index(s[0]), s[2]))


def weak_spans(text: str) -> list[tuple[str, str, int, int]]:
    """Candidates that mean nothing alone: kind, role, start, end."""
    return [
        (kind, role, *m.span())
        for kind, role, pattern in _WEAK
        if any(letter in text for letter in _NEEDS[kind])
        for m in pattern.finditer(text)
    ]


def outside(
    weak: list[tuple[str, str, int, int]], base: list[tuple[str, int, int]]
) -> list[tuple[str, str, int, int]]:
    """The weak spans that do not lie within a base finding, which are given by start."""
    starts = [start for _, start, _ in base]
    reach = list(accumulate((end for _, _, end in base), max))
    return [
        (kind, role, start, end)
        for kind, role, start, end in weak
        if not (i := bisect_right(starts, start)) or reach[i - 1] < end
    ]


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


_SPAN = pa.struct(
    [("kind", pa.string()), ("role", pa.string()), ("start", pa.int64()), ("end", pa.int64())]
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        strong, weak, hashes, counts = [], [], [], {kind: [] for kind in BASE_KINDS}
        for value in batch.column(2):
            text = value.as_py()
            base = base_spans(text)
            strong.append(
                [{"kind": k, "role": _ROLE_OF_BASE[k], "start": s, "end": e} for k, s, e in base]
            )
            weak.append(
                [
                    {"kind": k, "role": r, "start": s, "end": e}
                    for k, r, s, e in outside(weak_spans(text), base)
                ]
            )
            hashes.append(hashlib.sha256(listed(base).encode()).hexdigest())
            for kind in BASE_KINDS:
                counts[kind].append(sum(k == kind for k, _, _ in base))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                *(pa.array(counts[kind], pa.int64()) for kind in BASE_KINDS),
                pa.array(hashes, pa.string()),
                pa.array(strong, pa.list_(_SPAN)),
                pa.array(weak, pa.list_(_SPAN)),
            ],
            ["row", "id", "n_assign", "n_access", "n_hex", "base_sha256", "strong", "weak"],
        )


_ROLES = ("identifier", "secret", "endpoint")
_PLACE = "struct<start: bigint, end: bigint, kind: string>"


class SecretScan:
    """Findings in ``docs``, whole texts; NULL texts have none.

    The texts are read once; what is found in them is written and linked by joins.
    """

    def __init__(
        self, docs: DataFrame, id: str = "doc_id", text: str = "text", scope: int = SCOPE
    ):
        self.scope = scope
        kind = docs.schema[id].dataType.simpleString()
        span = "array<struct<kind:string,role:string,start:bigint,end:bigint>>"
        rows = docs.select(F.monotonically_increasing_id(), F.col(id), whole(text))
        self.scanned = materialize(
            rows.mapInArrow(
                _scan,
                f"row bigint, id {kind}, n_assign bigint, n_access bigint, n_hex bigint, "
                f"base_sha256 string, strong {span}, weak {span}",
            ),
            "scanned",
        )

    def parts(self) -> DataFrame:
        """All findings, a row each: ``row``, ``kind``, ``role``, ``start``, ``end``, ``weak``."""
        one = F.col("part.*")
        strong = self.scanned.select("row", F.explode("strong").alias("part"))
        weak = self.scanned.select("row", F.explode("weak").alias("part"))
        return strong.select("row", one, F.lit(False).alias("weak")).union(
            weak.select("row", one, F.lit(True).alias("weak"))
        )

    def links(self) -> DataFrame:
        """Parts with their complements: for each part and each other role the nearest part of
        that role within the scope that shares no letter with it (``row``, ``kind``, ``role``,
        ``start``, ``end``, ``weak``, ``other_role``, ``other_kind``, ``other_start``,
        ``other_end``).

        An interval join: a document is cut into stretches as long as the scope, and a part looks
        for partners that start in its own stretch and its two neighbours. Parts that end before it
        starts are met in the order of their ends, those that start after its end in the opposite
        order, and the best of each role so far is carried along, so no pairs of all parts arise.
        """
        parts = self.parts().where("end > start")
        stretch = F.floor(F.col("start") / self.scope)
        this = F.struct("start", "end", "kind")
        asking = parts.select(
            "row", stretch.alias("stretch"), F.struct(*parts.columns[1:]).alias("part"),
            *(F.lit(None).cast(_PLACE).alias(r) for r in _ROLES),
        )
        offered = parts.select(
            "row",
            F.explode(F.array(*(stretch + shift for shift in (-1, 0, 1)))).alias("stretch"),
            F.lit(None).cast(asking.schema["part"].dataType).alias("part"),
            *(F.when(F.col("role") == r, this).alias(r) for r in _ROLES),
            this.alias("own"),
        )
        sides = []
        for asked_at, offered_at, best, order in (
            ("start", "end", F.max, F.asc),
            ("end", "start", F.min, F.desc),
        ):
            # At one place, what is offered comes before what is asked.
            first = 0 if order is F.asc else 1
            events = asking.select(
                "row", "stretch", "part", *_ROLES, F.col(f"part.{asked_at}").alias("at"),
                F.lit(1 - first).alias("turn"),
            ).union(
                offered.select(
                    "row", "stretch", "part", *_ROLES, F.col(f"own.{offered_at}").alias("at"),
                    F.lit(first).alias("turn"),
                )
            )
            met = (
                Window.partitionBy("row", "stretch")
                .orderBy(order("at"), order("turn"))
                .rowsBetween(Window.unboundedPreceding, -1)
            )
            found = events.select("row", "part", *(best(r).over(met).alias(r) for r in _ROLES))
            choices = F.array(
                *(F.struct(F.lit(r).alias("role"), F.col(r).alias("part")) for r in _ROLES)
            )
            sides.append(
                found.where("part is not null").select("row", "part.*", F.explode(choices).alias("other"))
            )
        pairs = (
            sides[0]
            .union(sides[1])
            .where("other.part is not null and other.role <> role")
            .withColumn("distance", F.abs(F.col("start") - F.col("other.part.start")))
            .where(F.col("distance") <= self.scope)
        )
        nearest = F.min(F.struct("distance", "other.part")).alias("nearest")
        return (
            pairs.groupBy("row", "kind", "role", "start", "end", "weak", F.col("other.role").alias("other_role"))
            .agg(nearest)
            .select(
                "row", "kind", "role", "start", "end", "weak", "other_role",
                F.col("nearest.part.kind").alias("other_kind"),
                F.col("nearest.part.start").alias("other_start"),
                F.col("nearest.part.end").alias("other_end"),
            )
        )

    def findings(self) -> DataFrame:
        """A row per document: ``id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` and
        ``spans``: all base findings and the accepted weak ones, ``kind:start:end``, by start.

        A weak secret needs an identifier near by, a weak identifier a secret, and a weak endpoint
        both; a partner that is weak itself counts. Weak spans within a base finding take no part,
        neither as a finding, which the base one reports already, nor as a partner.
        """
        links = self.links().where("weak").groupBy("row", "kind", "role", "start", "end").agg(
            F.collect_set("other_role").alias("near")
        )
        has = lambda role: F.array_contains("near", role)
        accepted = links.where(
            ((F.col("role") == "secret") & has("identifier"))
            | ((F.col("role") == "identifier") & has("secret"))
            | ((F.col("role") == "endpoint") & has("secret") & has("identifier"))
        )
        weak = accepted.groupBy("row").agg(
            F.collect_list(F.struct("start", "kind", "end")).alias("accepted")
        )
        rank = F.create_map(*(x for i, k in enumerate(BASE_KINDS) for x in (F.lit(k), F.lit(i))))
        base = F.transform(
            "strong",
            lambda s: F.struct(
                s["start"].alias("start"),
                F.concat(rank[s["kind"]].cast("string"), s["kind"]).alias("kind"),
                s["end"].alias("end"),
            ),
        )
        extra = F.transform(
            F.coalesce("accepted", F.array()),
            lambda s: F.struct(
                s["start"].alias("start"),
                F.concat(F.lit("9"), s["kind"]).alias("kind"),
                s["end"].alias("end"),
            ),
        )
        spans = F.transform(
            F.array_sort(F.concat(base, extra)),
            lambda s: F.concat_ws(":", F.substring(s["kind"], 2, 100), s["start"], s["end"]),
        )
        return self.scanned.join(weak, "row", "left").select(
            "row", "id", "n_assign", "n_access", "n_hex", "base_sha256",
            F.concat_ws(",", spans).alias("spans"),
        )

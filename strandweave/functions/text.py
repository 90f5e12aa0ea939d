"""Names, accessions, labels and log lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NUCLEOTIDE_RUN = "[ACGTURYSWKMBDHVNacgturyswkmbdhvn-]{40,}"
REDACTED = "[SEQUENCE_REDACTED]"
LOG_CHARS = 1000


def strip_version(accession: Column) -> Column:
    return F.regexp_replace(accession, r"\.\d+$", "")


def slug(name: Column) -> Column:
    """Lower-case words joined by hyphens; ``dataset`` where nothing is left."""
    return F.coalesce(F.nullif(F.btrim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), F.lit("-")), F.lit("")), F.lit("dataset"))


def redact(message: Column) -> Column:
    """A log message without long runs of nucleotides, cut to LOG_CHARS."""
    return F.left(F.regexp_replace(message, NUCLEOTIDE_RUN, REDACTED), F.lit(LOG_CHARS))


def feature_label(qualifiers: Column, kind: Column) -> Column:
    """First gene, locus tag or product of a feature, else its type."""
    first = [F.nullif(F.try_element_at(qualifiers, F.lit(k))[0], F.lit("")) for k in ("gene", "locus_tag", "product")]
    return F.coalesce(*first, kind)


def fraction(value: Column, name: str) -> Column:
    """A finite share from 0 to 1; anything else fails the query rather than being clamped."""
    fine = value.isNull() | (~F.isnan(value) & value.between(0.0, 1.0))
    return F.when(fine, value).otherwise(F.raise_error(F.lit(f"{name} must be a finite fraction between 0 and 1")).cast("double"))


def sites(pairs: Column) -> Column:
    """(start, end) pairs as ``a-b,c-d``."""
    return F.array_join(F.transform(pairs, lambda s: F.concat(s["start"], F.lit("-"), s["end"])), ",")

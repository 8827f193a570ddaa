"""Column resolution by alias."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted header names of a membership snapshot, first wins.
MEMBER_ALIASES: dict[str, tuple[str, ...]] = {
    "person_id": ("num_personne", "numpersonne", "num_pers", "id_personne"),
    "contract_id": ("num_ctr_indiv", "contrat"),
    "member_type": ("type_assure", "typeassure"),
    "company": ("code_soc_appart", "code_societe", "societe", "code_soc"),
    "offer": ("offre", "code_offre", "libelle_offre", "nom_offre"),
    "last_name": ("nom_long", "nom", "nom_assure", "lastname"),
    "first_name": ("prenom", "firstname", "prenom_assure"),
    "birth_date": ("date_naissance", "birthdate", "ddn"),
    "email": ("mailciam", "mail_ciam", "email", "mail"),
    "contact_value": ("valeur_coordonnee", "valeur_coordonnees", "valeur coordonnee"),
    "kpep": ("idkpep", "kpep", "id_kpep"),
    "adhesion_date": ("date_adhesion", "date_entree", "date_adh"),
    "effect_date": ("date_effet_adhesion", "date_effet", "date_eff"),
    "cancel_date": ("dateradassure", "date_radiation", "date_rad"),
}

# Accepted header names of a directory extract.
ACCOUNT_ALIASES: dict[str, tuple[str, ...]] = {
    "id": ("id",),
    "realm_id": ("realm_id",),
    "idkpep": ("idkpep",),
    "email": ("email",),
    "email_other": ("email_other",),
    "last_name": ("last_name", "nom"),
    "first_name": ("first_name", "prenom"),
    "middlename": ("middlename",),
    "birthdate": ("birthdate", "date_naissance"),
    "phonenumber": ("phonenumber",),
}


def clean_header(name: str) -> str:
    """Lower case, no byte-order mark, quotes, accents or outer blanks."""
    text = name.replace("﻿", "").replace('"', "").strip().lower()
    return unicodedata.normalize("NFD", text).encode("ascii", "ignore").decode()


def storage_header(name: str) -> str:
    """Header as stored in a table: clean, blanks and dashes as underscores."""
    return re.sub(r"[.']", "", re.sub(r"[ \-]", "_", clean_header(name)))


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def resolve_columns(
    df: DataFrame,
    aliases: Mapping[str, Sequence[str]],
    defaults: Mapping[str, Column] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Project onto logical names: the first existing alias wins.

    Repeated headers count once.  A logical column without any alias takes its
    default, or NULL text.  ``keep`` names further columns passed through.
    """
    present: dict[str, str] = {}
    for name in df.columns:
        present.setdefault(clean_header(name), name)
    defaults = defaults or {}
    out = []
    for logical, names in aliases.items():
        hit = next((present[n] for n in (clean_header(a) for a in names) if n in present), None)
        col = _quoted(hit) if hit is not None else defaults.get(logical, F.lit(None).cast("string"))
        out.append(col.alias(logical))
    out += [_quoted(present[clean_header(k)]).alias(k) for k in keep if clean_header(k) in present]
    return df.select(*out)


def required_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Missing and unexpected columns of a block as ``(issue, item)`` rows."""
    have = {clean_header(c) for c in df.columns}
    need = {clean_header(c) for c in required}
    rows = [("MANQUANTE", c) for c in sorted(need - have)] + [("INATTENDUE", c) for c in sorted(have - need)]
    return df.sparkSession.createDataFrame(rows, "issue string, item string")


def unknown_codes(df: DataFrame, code: str, known: DataFrame) -> DataFrame:
    """Distinct non-null codes of ``df`` that the dimension does not hold."""
    codes = df.select(F.btrim(F.col(code)).alias("item")).where("item is not null").distinct()
    return codes.join(known.select(F.col(known.columns[0]).alias("item")), "item", "left_anti").select(
        F.lit("CODE_INCONNU").alias("issue"), "item"
    )

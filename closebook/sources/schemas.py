"""Declared schemas of the twelve star-schema tables (CSV headers as written).

Schemas are declared, never inferred: inference turns the 'yyyy-MM' month
key into a timestamp and the nullable budget ids into doubles.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B, DT = (T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(),
                     T.BooleanType(), T.DateType())


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


STAR_SCHEMAS: dict[str, T.StructType] = {
    "dim_date": _struct(
        ("date", DT), ("date_id", I), ("jour", I), ("mois", I), ("annee", I),
        ("trimestre", I), ("semaine", I), ("jour_semaine", S), ("est_weekend", B),
        ("annee_mois", S), ("est_soldes", B), ("est_black_fri", B), ("est_noel", B)),
    "dim_canal": _struct(("canal_id", I), ("canal", S), ("part_ca_cible", D), ("marge_cible", D)),
    "dim_categorie": _struct(("categorie_id", I), ("categorie", S), ("part_ca_cible", D),
                             ("marge_cible", D)),
    "dim_produit": _struct(("sku", S), ("libelle", S), ("categorie_id", I), ("categorie", S),
                           ("prix_vente_ht", D), ("prix_achat_ht", D), ("collection", S)),
    "dim_client": _struct(("client_id", S), ("segment", S), ("date_creation", DT)),
    "dim_centre_cout": _struct(("cc_id", S), ("centre_cout", S), ("masse_salariale_mens", I)),
    "fact_ventes": _struct(
        ("commande_id", S), ("date_cmd", DT), ("client_id", S), ("sku", S), ("canal_id", I),
        ("quantite", I), ("prix_unit_ht", D), ("ca_ht", D), ("cout_achat_ht", D)),
    "fact_encaissements": _struct(
        ("commande_id", S), ("date_cmd", DT), ("date_encaissement", DT), ("montant_ht", D),
        ("delai_jours", I)),
    "fact_achats": _struct(
        ("facture_id", S), ("date_facture", DT), ("sku", S), ("quantite", I),
        ("montant_marchandises_ht", D), ("montant_transport_ht", D), ("montant_total_ht", D),
        ("delai_paiement_fourn", I)),
    "fact_charges": _struct(("date_charge", DT), ("cc_id", S), ("nature_charge", S),
                            ("montant_ht", D)),
    "fact_paie": _struct(("date_paie", DT), ("cc_id", S), ("masse_salariale_ht", D)),
    # canal_id / categorie_id are written as 1.0 because the charge rows leave
    # them empty: read DOUBLE here, cast to INT once in ``star.read_star``.
    "fact_budget": _struct(
        ("annee", I), ("mois", I), ("type", S), ("canal_id", D), ("categorie_id", D),
        ("cc_id", S), ("montant_budget", D), ("marge_budget_pc", D)),
}

STAR_TABLES = tuple(STAR_SCHEMAS)

# Fact tables written partitioned by month when the star is persisted.
MONTH_PARTITIONED = {
    "fact_ventes": "date_cmd",
    "fact_encaissements": "date_cmd",
    "fact_achats": "date_facture",
    "fact_charges": "date_charge",
    "fact_paie": "date_paie",
}

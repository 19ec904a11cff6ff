"""Column roles: which physical column plays which part in a purchase table.

The analyses are written against roles (client, time, amount, category, id)
so the same operator runs on any table that has them.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Roles:
    client: str = "client_id"
    ts: str = "date_achat"
    amount: str = "montant_achat"
    category: str = "categorie_produit"
    # unique row id, used as the tie-break whenever rows are ordered by time
    id: str = "purchase_id"

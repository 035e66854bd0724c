"""Picking models by name, layer, tag and place in the dependency graph.

A pick is a list of words; a model is picked if any word picks it. A word is a model or source
table, a layer, or ``tag:`` and a tag. ``+`` before it adds all that the picked depend on,
``+`` after it all that depends on them. Words joined by commas pick what all of them pick.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Model:
    layer: str
    parents: tuple[str, ...] = ()
    tags: tuple[str, ...] = ()


def _layer(layer: str, tags: dict[str, str] | None = None, **parents: str) -> dict[str, Model]:
    return {name: Model(layer, tuple(p.split()), tuple((tags or {}).get(name, "").split())) for name, p in parents.items()}


# What each model is built from, and its tags.
MODELS: dict[str, Model] = {
    **_layer("source", users="", locations="", products="", orders="", order_items="", user_events="", exchange_rates=""),
    **_layer(
        "staging",
        stg_users="users",
        stg_locations="locations exchange_rates",
        stg_orders="orders",
        stg_order_items="order_items",
        stg_products="products",
        stg_user_events="user_events stg_users stg_locations",
    ),
    **_layer(
        "staging_incremental",
        tags={
            "stg_orders_incr": "incremental fact",
            "stg_order_items_incr": "incremental fact",
            "stg_user_events_incr": "incremental fact high-volume",
        },
        stg_orders_incr="orders users locations",
        stg_order_items_incr="order_items",
        stg_user_events_incr="user_events stg_users stg_locations",
    ),
    **_layer(
        "mart",
        dim_products="stg_products",
        dim_users="stg_users stg_locations",
        fct_orders="stg_orders stg_order_items",
        fct_order_items="stg_order_items stg_orders stg_products",
        fct_user_events="stg_user_events stg_products",
    ),
    **_layer("snapshot", snap_locations="locations exchange_rates"),
}


def ancestors(name: str) -> set[str]:
    """All that a model depends on."""
    found = set(MODELS[name].parents)
    return found.union(*(ancestors(parent) for parent in found))


def descendants(name: str) -> set[str]:
    """All that depends on a model."""
    return {other for other in MODELS if name in ancestors(other)}


def _pick_word(word: str) -> set[str]:
    name = word.strip("+")
    if name.startswith("tag:"):
        found = {m for m, model in MODELS.items() if name[4:] in model.tags}
    else:
        found = {m for m, model in MODELS.items() if name in (m, model.layer)}
    if not found:
        raise ValueError(f"{word!r} picks no model")
    before = set().union(*map(ancestors, found)) if word.startswith("+") else set()
    after = set().union(*map(descendants, found)) if word.endswith("+") else set()
    return found | before | after


def pick(words: str) -> set[str]:
    """The names of the models that ``words`` pick."""
    return set().union(*(set.intersection(*map(_pick_word, word.split(","))) for word in words.split()))

"""a small shop with planted faults (our own values)."""

from datetime import datetime
from decimal import Decimal as D

from tillroll import schemas
from tillroll.sources.inline import inline_rows

T0 = datetime(2025, 9, 1, 10, 30)

CATEGORIES = [(1, "Bebidas", None), (2, "Padaria", "Pães"), (3, "Laticínios", None)]

PRODUCTS = [
    (1, "Café torrado", None, D("19.90"), 10, 1, T0, T0),
    (2, "Pão de forma", None, D("8.50"), 0, 2, T0, T0),
    (3, "Queijo", "Meia cura", D("42.00"), 5, 3, T0, T0),
    (4, "Sacola", None, D("0.50"), 100, None, T0, T0),  # NULL category: passes FK
]

CUSTOMERS = [
    (1, "Ana", "ana@example.org", "11 5555-0101", T0, False),
    (2, "Bruno", "bruno@example.org", None, T0, False),
    (2, "Bruna", "bruna@example.org", None, T0, False),            # duplicate id
    (4, "Caio", "ana@example.org", "123456789012345678901", T0, True),  # dup e-mail, 21-char phone
]

ORDERS = [
    (10, 1, T0, D("48.30")),   # matches its items
    (11, 2, T0, D("42.10")),   # declares 0.10 more than its items
    (12, 1, T0, D("19.90")),   # has no items
]

ITEMS = [
    (100, 10, 1, 2, D("19.90")),
    (101, 10, 2, 1, D("8.50")),
    (102, 11, 3, 1, D("42.00")),
    (103, 11, 99, 0, D("0.00")),  # unknown product
]


def frames(spark):
    return {
        "categorias_produto": inline_rows(spark, CATEGORIES, schemas.CATEGORIAS_PRODUTO),
        "produto": inline_rows(spark, PRODUCTS, schemas.PRODUTO),
        "cliente": inline_rows(spark, CUSTOMERS, schemas.CLIENTE),
        "pedido_cabecalho": inline_rows(spark, ORDERS, schemas.PEDIDO_CABECALHO),
        "pedido_itens": inline_rows(spark, ITEMS, schemas.PEDIDO_ITENS),
    }

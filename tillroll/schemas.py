"""Explicit schemas: the shop tables (A14) and the nested documents.

Nothing is inferred. Optional document fields are part of one union schema
and come back as NULL where a record lacks them.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, IntegerType, LongType,
    StringType, StructField, StructType, TimestampType,
)

from tillroll.functions.money import MONEY


def _f(name, dtype, nullable=True):
    return StructField(name, dtype, nullable)


# ------------------------------------------------------------ demo products
PRODUCTS_FLAT = StructType([
    _f("Produto", StringType()),
    _f("Categoria", StringType()),
    _f("Preco", DoubleType()),
    _f("Estoque", LongType()),
])

# ------------------------------------------------------------ shop tables
CATEGORIAS_PRODUTO = StructType([
    _f("id", IntegerType(), False),
    _f("nome", StringType(), False),
    _f("descricao", StringType()),
])

PRODUTO = StructType([
    _f("id", IntegerType(), False),
    _f("nome", StringType(), False),
    _f("descricao", StringType()),
    _f("preco", MONEY, False),
    _f("estoque", IntegerType(), False),
    _f("id_categoria", IntegerType()),
    _f("data_criacao", TimestampType(), False),
    _f("data_atualizacao", TimestampType(), False),
])

CLIENTE = StructType([
    _f("id", IntegerType(), False),
    _f("nome", StringType(), False),
    _f("email", StringType(), False),
    _f("telefone", StringType()),
    _f("data_cadastro", TimestampType()),
    _f("is_date", BooleanType(), False),
])

PEDIDO_CABECALHO = StructType([
    _f("id", IntegerType(), False),
    _f("id_cliente", IntegerType(), False),
    _f("data_pedido", TimestampType()),
    _f("valor_total", MONEY, False),
])

PEDIDO_ITENS = StructType([
    _f("id", IntegerType(), False),
    _f("id_pedido", IntegerType(), False),
    _f("id_produto", IntegerType(), False),
    _f("quantidade", IntegerType(), False),
    _f("preco_unitario", MONEY, False),
])

# Declared character limits of the shop tables' VARCHAR columns.
VARCHAR_LIMITS = {
    ("categorias_produto", "nome"): 100,
    ("produto", "nome"): 255,
    ("cliente", "nome"): 150,
    ("cliente", "email"): 255,
    ("cliente", "telefone"): 20,
}

# ------------------------------------------------------------ documents
STATEMENTS = StructType([
    _f("id_extrato", StringType()),
    _f("periodo", StructType([_f("data_inicio", StringType()), _f("data_fim", StringType())])),
    _f("cliente", StructType([
        _f("cliente_id", StringType()), _f("nome", StringType()), _f("documento", StringType()),
    ])),
    _f("conta", StructType([
        _f("banco", StringType()), _f("agencia", StringType()),
        _f("numero_conta", StringType()), _f("tipo", StringType()),
    ])),
    _f("saldos", StructType([_f("saldo_anterior", MONEY), _f("saldo_atual", MONEY)])),
    _f("transacoes", ArrayType(StructType([
        _f("id_transacao", StringType()), _f("data", StringType()), _f("descricao", StringType()),
        _f("valor", MONEY), _f("tipo", StringType()),
    ]))),
])

ORDER_DOC = StructType([
    _f("id_pedido", StringType()),
    _f("data_pedido", StringType()),
    _f("status", StringType()),
    _f("cliente", StructType([
        _f("id_cliente", StringType()), _f("nome", StringType()), _f("email", StringType()),
    ])),
    _f("itens", ArrayType(StructType([
        _f("sku", StringType()), _f("produto", StringType()),
        _f("quantidade", IntegerType()), _f("preco_unitario", MONEY),
    ]))),
    _f("entrega", StructType([
        _f("metodo", StringType()),
        _f("taxa_frete", MONEY),
        _f("endereco", StructType([
            _f("rua", StringType()), _f("numero", IntegerType()), _f("complemento", StringType()),
            _f("cidade", StringType()), _f("estado", StringType()), _f("cep", StringType()),
        ])),
    ])),
    _f("total_pedido", MONEY),
])

PRODUCT_ENVELOPE = StructType([
    _f("api_version", StringType()),
    _f("produtos", ArrayType(StructType([
        _f("id", IntegerType()),
        _f("nome", StringType()),
        _f("categoria", StringType()),
        _f("preco", MONEY),
        _f("disponivel", BooleanType()),
        _f("tags", ArrayType(StringType())),
        _f("especificacoes", StructType([
            _f("processador", StringType()), _f("ram", StringType()), _f("armazenamento", StringType()),
        ])),
        _f("variacoes", ArrayType(StructType([
            _f("cor", StringType()), _f("tamanho", StringType()), _f("estoque", IntegerType()),
        ]))),
        _f("detalhes", StructType([
            _f("origem", StringType()), _f("peso_g", IntegerType()), _f("torra", StringType()),
        ])),
        _f("avaliacoes", StringType()),
        _f("preco_anterior", MONEY),
    ]))),
])

TAG_LISTS = StructType([
    _f("produto_id", IntegerType()),
    _f("nome", StringType()),
    _f("tags", ArrayType(StringType())),
])

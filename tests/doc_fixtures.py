"""Nested documents of our own, written as pretty-printed JSON files
by the tests. Field names follow the schemas; records and totals do not follow
any other document."""

import json
import os


def _tx(number, day, what, value):
    return {"id_transacao": f"L{number}", "data": f"2024-02-{day:02d}T06:15:00Z", "descricao": what, "valor": value,
            "tipo": "DEBITO" if value < 0 else "CREDITO"}


def _statement(number, account, opening, closing, transactions):
    return {
        "id_extrato": f"FEV-{number}",
        "periodo": {"data_inicio": "2024-02-01T06:15:00Z", "data_fim": "2024-02-29T06:15:00Z"},
        "cliente": {"cliente_id": f"K{number}", "nome": f"Cliente {number}", "documento": f"doc-{number}"},
        "conta": {"banco": "900", "agencia": f"{number:04d}", "numero_conta": account, "tipo": "corrente"},
        "saldos": {"saldo_anterior": opening, "saldo_atual": closing},
        "transacoes": transactions,
    }


STATEMENTS = [
    _statement(1, "70-1", 90.00, 90.00, []),  # a month without transactions
    _statement(2, "70-2", 10.00, 262.35, [_tx(1, 1, "Venda", 300.00), _tx(2, 9, "Tarifa", -12.65), _tx(3, 17, "Frete", -40.00),
                                          _tx(4, 29, "Juros", 5.00)]),
    _statement(3, "70-3", 0.00, -75.40, [_tx(5, 12, "Papel", -75.40)]),
    _statement(4, "70-4", 1200.10, 1000.00, [_tx(6, 3, "Aluguel", -500.10), _tx(7, 28, "Venda", 300.00)]),
]

ORDER = {
    "id_pedido": "V-77", "data_pedido": "2024-02-05T18:40:00Z", "status": "ENVIADO",
    "cliente": {"id_cliente": "K5", "nome": "Elias", "email": "elias@example.org"},
    "itens": [
        {"sku": "P1", "produto": "Parafuso", "quantidade": 200, "preco_unitario": 0.15},
        {"sku": "P2", "produto": "Porca", "quantidade": 200, "preco_unitario": 0.10},
        {"sku": "P3", "produto": "Chave", "quantidade": 1, "preco_unitario": 62.90},
        {"sku": "P4", "produto": "Luva", "quantidade": 6, "preco_unitario": 8.35},
        {"sku": "P5", "produto": "Brinde", "quantidade": 1, "preco_unitario": 0.00},
    ],
    "entrega": {"metodo": "retirada", "taxa_frete": 0.00,
                "endereco": {"rua": "Largo do Porto", "numero": 4, "complemento": None,
                             "cidade": "Belém", "estado": "PA", "cep": "66000-000"}},
    "total_pedido": 163.00,
}

PRODUCTS = {
    "api_version": "7",
    "produtos": [
        {"id": 31, "nome": "Lanterna", "categoria": "Camping", "preco": 48.00, "disponivel": False, "preco_anterior": 55.00,
         "variacoes": [{"cor": "verde", "tamanho": "U", "estoque": 0}]},
        {"id": 32, "nome": "Corda", "categoria": "Camping", "preco": 19.00, "disponivel": True, "preco_anterior": 21.00},
        {"id": 33, "nome": "Mapa", "categoria": "Livros", "preco": 12.50, "disponivel": True},
        {"id": 34, "nome": "Barraca", "categoria": "Camping", "preco": 310.00, "disponivel": True, "tags": [],
         "variacoes": [{"cor": "cinza", "tamanho": "2", "estoque": 3}, {"cor": "cinza", "tamanho": "4", "estoque": 0}],
         "detalhes": {"origem": "Sul", "peso_g": 4100, "torra": None}},
        {"id": 35, "nome": "Tablet", "categoria": "Eletro", "preco": 900.00, "disponivel": True,
         "especificacoes": {"processador": "4 nucleos", "ram": "4GB", "armazenamento": "64GB"},
         "detalhes": {"origem": "Norte", "peso_g": 480, "torra": None}, "avaliacoes": None},
    ],
}

TAGS = [
    {"produto_id": 31, "nome": "Lanterna", "tags": None},
    {"produto_id": 32, "nome": "Corda", "tags": ["noite", "trilha", "noite"]},
    {"produto_id": 33, "nome": "Mapa", "tags": ["trilha"]},
    {"produto_id": 34, "nome": "Barraca", "tags": []},
    {"produto_id": 35, "nome": "Tablet", "tags": None},
    {"produto_id": 36, "nome": "Bota", "tags": ["trilha", "chuva"]},
    {"produto_id": 37, "nome": "Capa", "tags": []},
]


def write(folder, name, value):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, indent=2)
    return path

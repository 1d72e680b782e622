"""DDL of a block in JSON (verbosity 2)."""

from __future__ import annotations

VIN = "array<struct<coinbase: string, txid: string, vout: int, scriptSig: struct<hex: string>, txinwitness: array<string>, sequence: bigint>>"
VOUT = "array<struct<value: decimal(18,8), n: int, scriptPubKey: struct<hex: string, type: string, address: string, addresses: array<string>>>>"
TX = f"array<struct<txid: string, version: int, locktime: bigint, size: int, vsize: int, weight: int, fee: decimal(18,8), vin: {VIN}, vout: {VOUT}>>"
BLOCK_JSON = f"struct<hash: string, previousblockhash: string, merkleroot: string, time: bigint, bits: string, nonce: bigint, version: int, size: int, weight: int, tx: {TX}, _corrupt: string>"

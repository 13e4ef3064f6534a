"""Batch operators: inference, filters, sorting, fanout, variants, evolution."""

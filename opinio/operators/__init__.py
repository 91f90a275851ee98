"""opinio.operators"""

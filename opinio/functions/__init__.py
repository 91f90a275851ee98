"""opinio.functions"""

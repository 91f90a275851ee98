"""opinio.streaming"""

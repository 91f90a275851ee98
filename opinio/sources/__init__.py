"""opinio.sources"""

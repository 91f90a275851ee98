"""opinio.plans"""

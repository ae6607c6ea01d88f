"""millrace.operators"""

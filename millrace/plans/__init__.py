"""millrace.plans"""

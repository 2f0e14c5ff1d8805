"""heliograph.plans"""

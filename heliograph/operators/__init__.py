"""heliograph.operators"""

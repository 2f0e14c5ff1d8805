"""heliograph.streaming"""

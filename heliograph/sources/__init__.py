"""heliograph.sources"""

"""heliograph.functions"""

"""regscope.operators"""

"""regscope.functions"""

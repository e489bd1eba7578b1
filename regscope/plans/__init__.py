"""regscope.plans"""

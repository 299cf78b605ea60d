"""factline.plans"""
